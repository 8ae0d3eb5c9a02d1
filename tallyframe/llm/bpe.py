"""BPE encoding and decoding as streaming transducers.

Encoding. For a list of merges in which every token has one merge and is built from earlier ones, a token
sequence is what the merges give for its text exactly if each pair of neighbours is (``fits``: the merges
turn the two tokens' symbols into just these two). So each prefix of a word has one last token, found from
the last tokens of shorter prefixes, and the encoding of a word is the chain of last tokens back from its
end. A later symbol can reach back over at most the longest token (``Merges.lookahead`` symbols), so
tokens are final once the chains of the last ``lookahead`` prefixes have met; they are emitted then, and
the state holds only the prefixes after that point. The lookahead is computed from the merge list. Every word
goes through the transducer; the ids of short words are kept for the next time, in a cache of fixed size. Texts
are cut into words first, as the tokenizer file says: special tokens, NFC, white space, lower case, then its split
pattern, in parts of ``PART`` characters, so beside a row's text and its ids the state doesn't grow with the text (a
stretch without a space is one part).

Decoding. ``SurfaceDecoder`` gives what the library's ``decode`` gives for a file without a decoder: the
token strings with a space between them. ``TextDecoder`` is a byte machine: token characters become bytes,
an end-of-word mark becomes a space, and bytes become characters once a sequence is complete; broken
sequences give U+FFFD.

Cases: a null or empty text has no ids and decodes to an empty text; repeated rows give equal results.
"""

from __future__ import annotations

import codecs
import json
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyframe.llm.arrowmap import with_text_columns
from tallyframe.llm.bytewords import released_memory

END = "</w>"
#: White space as the tokenizer's pattern engine has it: U+001C to U+001F are not.
_SPACE = r"\t-\r \x85\xa0  -     　"
#: Code points that this regex module counts as letters and the tokenizer's pattern engine, at Unicode 16, doesn't.
_LATER = "558-558 58b-58c 88f-88f c5c-c5c cdc-cdc 208f-208f 209d-209f a7ce-a7cf a7d2-a7d2 a7d4-a7d4 a7dd-a7f1 ab6c-ab6d 107bb-107bf 10940-10959 10ec5-10eee 11b0a-11b0a 11db0-11df1 16ea0-16ed3 16ff2-16ff3 187f8-187ff 18cd6-18cda 18d09-191d2 1b123-1b128 1b168-1b168 1d6a6-1d6a6 1df1f-1df24 1df2b-1dfff 1e6c0-1e6ff 2b73a-2b73f 2b81e-2b81e 2cea2-2cead 323b0-3fc3f"
#: The same for numbers.
_LATER_NUMBERS = "1246f-1246f 12475-1247f 12550-12686 16ff4-16ff6"
_NOT_LETTERS, _NOT_NUMBERS = ("".join(f"\\U{int(a, 16):08x}-\\U{int(b, 16):08x}" for a, b in (x.split("-") for x in later.split())) for later in (_LATER, _LATER_NUMBERS))
_LETTER = rf"[\p{{L}}--[{_NOT_LETTERS}]]"
#: Words are tried first, those of plain Latin letters by a class that the engine tests quickly; an apostrophe starts no word.
_SPLIT_ASCII = re.compile(r"[a-z]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\t-\r a-z0-9]+")
#: Texts of Latin-1 and common punctuation alone are in normal form, and the same split is written with Python's own engine.
_WESTERN = re.compile(r"[\x00-\xff\u2010-\u2027\u20ac]*")
_SPLIT_WESTERN = re.compile(r"[a-zªµºß-öø-ÿ]+|'(?:s|t|re|ve|m|ll|d)|[0-9²³¹¼½¾]|[^\t-\r \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼½¾]+")
_SPLIT = regex.compile(rf"[a-zß-öø-ÿ]+(?!\p{{L}})|{_LETTER}+|'(?:s|t|re|ve|m|ll|d)|[\p{{N}}--[{_NOT_NUMBERS}]]|[[^{_SPACE}\p{{L}}\p{{N}}]||[{_NOT_LETTERS}{_NOT_NUMBERS}]]+", regex.V1)
#: Capitals of Unicode 16 and 17 whose small letters Python's own tables lack.
_LOWER_LATER = {0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7DA: 0xA7DB, 0xA7DC: 0x019B} | {c: c + 32 for c in range(0x10D50, 0x10D66)} | {0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5} | {c: c + 27 for c in range(0x16EA0, 0x16EB9)}
_CAPITAL_LATER = regex.compile("[" + "".join(map(chr, _LOWER_LATER)) + "]")
#: Words whose encoding is kept in each of two generations, pairs whose fit is kept, and beginnings of words up to START symbols whose last token is kept, for one Python worker.
KEPT_WORDS, KEPT_PAIRS, KEPT_STARTS, START = 100_000, 100_000, 200_000, 6
#: Characters that are normalised and split together, and ids that are decoded together.
PART = 1 << 16


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in shown:
            out[b] = chr(b)
        else:
            out[b] = chr(spare)
            spare += 1
    return out


ALPHABET = byte_alphabet()
_TO_ALPHABET = {b: c for b, c in enumerate(ALPHABET) if ord(c) != b}


class Merges:
    """Vocabulary and merge ranks, and what follows from them for a streaming encoder."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]], special: dict[str, int]):
        self.vocab, self.special = vocab, special
        self.rank = {tuple(pair): k for k, pair in enumerate(merges)}
        self.tokens = [""] * (1 + max([*vocab.values(), *special.values()]))
        for token, i in [*vocab.items(), *special.items()]:
            self.tokens[i] = token
        length = lambda token: len(token) - len(END) * token.endswith(END)
        #: Each token that a merge makes: its parts and the merge's rank.
        self.made = {a + b: (a, b, k) for (a, b), k in self.rank.items()}
        if len(self.made) < len(self.rank):
            raise ValueError("a token has two merges")
        wide: dict[str, int] = {}
        for token, (a, b, _) in self.made.items():
            wide[token] = wide.get(a, 1) + wide.get(b, 1)
        #: Symbols that the widest merge spans. Every encoding has a token boundary in any so many neighbouring places, so
        #: a symbol can change no token that ends further back than that.
        self.lookahead = max(wide.values(), default=1)
        #: Every end of a token, with the id of the token that it is, else -1.
        self.tails = dict.fromkeys((t[i:] for t in vocab for i in range(length(t))), -1) | {t: i for t, i in vocab.items() if length(t)}
        self.pairs: dict[int, bool] = {}
        self.alone: dict[int, bool] = {}
        #: The last token of words' beginnings and its width, for beginnings of up to START symbols.
        self.starts: dict[str, int] = {}

    def merged(self, symbols: list[str]) -> list[str]:
        """What the merges make of the symbols: the best-ranked pair first, the leftmost of equals."""
        symbols = list(symbols)
        get, none = self.rank.get, len(self.rank)
        ranks = [get(p, none) for p in zip(symbols, symbols[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            at = ranks.index(best)
            symbols[at] += symbols.pop(at + 1)
            del ranks[at]
            if at:
                ranks[at - 1] = get((symbols[at - 1], symbols[at]), none)
            if at < len(ranks):
                ranks[at] = get((symbols[at], symbols[at + 1]), none)
        return symbols

    @staticmethod
    def symbols(token: str) -> list[str]:
        return [*token[: -len(END) - 1], token[-len(END) - 1 :]] if token.endswith(END) and len(token) > len(END) else [*token]

    def stands(self, b: int) -> bool:
        """Whether the merges make this token of its own symbols."""
        known = self.alone.get(b)
        if known is None:
            known = self.alone[b] = self.merged(self.symbols(self.tokens[b])) == [self.tokens[b]]
        return known

    def apart(self, x: str, y: str) -> bool:
        """Whether no merge joins anything across the border of two tokens that stand next to each other.

        The merges that made the tokens are undone, the last first; a merge of what then meets at the border would have come
        before the one just undone if its rank is lower, or equal and further to the left.
        """
        rank, made, before = self.rank.get, self.made.get, len(self.rank)
        base = ("", "", -1)
        while True:
            if rank((x, y), before) < before:
                return False
            left, right = made(x, base), made(y, base)
            if left[2] > right[2]:
                x, before = left[1], left[2]
            elif right[2] >= 0:
                y, before = right[0], right[2] + 1
            else:
                return True

    def fits(self, a: int, b: int) -> bool:
        """Whether the merges make a, b of the symbols of both, where a stands; with -1 for a, whether they make b of its own."""
        key = a << 20 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.stands(b) and (a < 0 or self.apart(self.tokens[a], self.tokens[b]))
        return known


class WordEncoder:
    """Encodes one word, fed piece by piece; ids come out as soon as nothing that follows can change them."""

    def __init__(self, merges: Merges):
        self.m = merges
        self.text = ""  # symbols of the prefixes that are held
        self.last: list[int] = [-1]  # last token of each held prefix; -1 at the start of a word
        self.size: list[int] = [0]
        self.before = -1  # the token emitted last in this word
        self.checked = 0

    def _extend(self, symbols: str, end: str = "") -> None:
        """Finds the last token of each prefix that the symbols add; ``end`` marks the last of them as the word's."""
        m, last, size = self.m, self.last, self.size
        tail, pair, fits = m.tails.get, m.pairs.get, m.fits
        at, before = len(last) - 1, self.before
        text = self.text = self.text + symbols
        # the last token of a word's first symbols is the same in every word that begins with them
        known_starts, starts = m.starts.get, m.starts
        for i in range(at + 1, len(text) + 1):
            mark = end if i == len(text) else ""
            start = text[:i] if before < 0 and i <= START and not mark else ""
            if start and (held := known_starts(start)):
                last.append(held >> 6)
                size.append(held & 63)
                continue
            for n in range(1, i + 1):
                token = tail(text[i - n : i] + mark)
                if token is None:
                    raise ValueError(f"no token ends at {text[max(0, i - 8):i]!r}: the merge list is not proper")
                if token < 0:
                    continue
                left = last[i - n] if i > n else before
                known = pair(left << 20 | token)
                if known is None:
                    known = fits(left, token)
                if known:
                    last.append(token)
                    size.append(n)
                    if start and n < 64 and len(starts) < KEPT_STARTS:
                        starts[start] = token << 6 | n
                    break
            else:
                raise ValueError(f"no token ends at {text[max(0, i - 8):i]!r}: the merge list is not proper")

    def _back(self, upto: int) -> list[int]:
        out = []
        while upto:
            out.append(self.last[upto])
            upto -= self.size[upto]
        return out[::-1]

    def _settled(self) -> list[int]:
        """Emits what the chains of the last ``lookahead`` prefixes have in common."""
        open_ends = set(range(max(0, len(self.last) - self.m.lookahead), len(self.last)))
        while len(open_ends) > 1:
            far = max(open_ends)
            open_ends.remove(far)
            open_ends.add(far - self.size[far] if far else 0)
        at = open_ends.pop()
        if not at:
            return []
        out = self._back(at)
        self.before = out[-1]
        self.text = self.text[at:]
        self.last, self.size = [-1, *self.last[at + 1 :]], [0, *self.size[at + 1 :]]
        return out

    def feed(self, symbols: str) -> Iterator[int]:
        """More symbols of the word, none of them its last."""
        wide = 2 * self.m.lookahead
        for at in range(0, len(symbols), wide):
            part = symbols[at : at + wide]
            self._extend(part)
            if len(self.last) > 2 * wide:
                yield from self._settled()

    def finish(self, symbol: str) -> list[int]:
        """The word's last symbol."""
        self._extend(symbol, END)
        out = self._back(len(self.last) - 1)
        self.text, self.last, self.size, self.before = "", [-1], [0], -1
        return out


def parts(text: str, size: int = PART) -> Iterator[str]:
    """A text in parts of ``size`` characters and up to the next space: neither NFC nor a word reaches over a space."""
    at = 0
    while len(text) - at > size and (cut := text.find(" ", at + size)) >= 0:
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text


class Encoder:
    def __init__(self, merges: Merges):
        self.m, self.transducer = merges, WordEncoder(merges)
        #: Two generations of known words: when the young one is full it becomes the old one, so words in use stay.
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.marks = regex.compile("|".join(map(regex.escape, sorted(merges.special, key=len, reverse=True)))) if merges.special else None

    def word(self, word: str) -> Iterator[int]:
        """The ids of a word, streamed through the transducer."""
        raw = word if word.isascii() else word.encode("utf-8", "surrogatepass").decode("latin-1")
        raw = raw.translate(_TO_ALPHABET)
        yield from self.transducer.feed(raw[:-1])
        yield from self.transducer.finish(raw[-1])

    def forget(self) -> None:
        """Drops the words that are kept: the merges stay in the worker, the words of a task don't."""
        self.words, self.older = {}, {}

    def _kept(self, word: str) -> bytes:
        made = self.words.get(word) or self.older.get(word) or array("i", self.word(word)).tobytes()
        if len(word) <= 64:
            if len(self.words) >= KEPT_WORDS:
                self.older, self.words = self.words, {}
            self.words[word] = made
        return made

    def pieces(self, text: str) -> Iterator[bytes]:
        """The ids of a text as int32 bytes, in pieces."""
        at = 0
        for mark in self.marks.finditer(text) if self.marks and "<" in text else ():
            for part in parts(text[at : mark.start()]):
                yield self._plain(part)
            yield np.int32(self.m.special[mark[0]]).tobytes()
            at = mark.end()
        for part in parts(text[at:] if at else text):
            yield self._plain(part)

    def _plain(self, text: str) -> bytes:
        if text.isascii():
            words = _SPLIT_ASCII.findall(text.lower())
        elif _WESTERN.fullmatch(text):
            words = _SPLIT_WESTERN.findall(text.lower())
        else:
            # the library lowers character by character: a capital sigma never takes its final form
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
            if _CAPITAL_LATER.search(text):
                text = text.translate(_LOWER_LATER)
            words = _SPLIT.findall(text)
        made = list(map(self.words.get, words))
        if None in made:
            known, kept = self.words.get, self._kept
            made = [known(w) or kept(w) for w in words]
        return b"".join(made)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(self.pieces(text)), np.int32)


class SurfaceDecoder:
    """Token strings with a space between them, fed ids piece by piece."""

    def __init__(self, merges: Merges):
        self.tokens, self.due = merges.tokens, ""

    def feed(self, ids: list[int]) -> str:
        if not ids:
            return ""
        out = self.due + " ".join(map(self.tokens.__getitem__, ids))
        self.due = " "
        return out

    def finish(self) -> str:
        self.due = ""
        return ""


class TextDecoder:
    """The text that ids stand for: bytes become characters once complete, an end of word becomes a space."""

    def __init__(self, merges: Merges):
        alphabet, special = {c: b for b, c in enumerate(ALPHABET)}, set(merges.special.values())
        self.parts: list[bytes] = []
        for i, token in enumerate(merges.tokens):
            ends = token.endswith(END) and len(token) > len(END)
            body = token[: -len(END)] if ends else token
            self.parts.append(token.encode() if i in special else bytes(alphabet[c] for c in body) + b" " * ends)
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        return self.machine.decode(b"".join(map(self.parts.__getitem__, ids)))

    def finish(self) -> str:
        out = self.machine.decode(b"", True)
        self.machine.reset()
        return out


@lru_cache(maxsize=2)
def load(path: str) -> Encoder:
    """The encoder of a tokenizers file with a BPE model; kept by each Python worker."""
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    model = made["model"]
    if model["type"] != "BPE" or model["end_of_word_suffix"] != END:
        raise ValueError(f"{path} is not a BPE file with ends of words")
    merges = [tuple(x) if isinstance(x, list) else tuple(x.split(" ")) for x in model["merges"]]
    return Encoder(Merges(model["vocab"], merges, {t["content"]: t["id"] for t in made["added_tokens"]}))


def _coded(encoder: Encoder, texts: list[bytes]) -> pa.ListArray:
    made = [b"".join(encoder.pieces(t.decode("utf-8", "replace"))) for t in texts]
    offsets = np.zeros(len(made) + 1, np.int32)
    np.cumsum([len(x) // 4 for x in made], out=offsets[1:])
    values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(made))])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _decoded(machine: SurfaceDecoder | TextDecoder, ids: pa.Array) -> pa.Array:
    values = ids.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(ids), 0).to_numpy()).tolist()
    texts = []
    for low, high in zip([0, *ends], ends):
        pieces = [machine.feed(values[a : min(a + PART, high)].tolist()) for a in range(low, high, PART)]
        texts.append("".join(pieces) + machine.finish())
    return pa.array(texts, pa.string())


def encode_texts(df: DataFrame, path: str, text_col: str = "text", ids: str = "ids", load_encoder: Callable[[str], Encoder] = load) -> DataFrame:
    """df with ``ids``: array<int>, the text's tokens. ``path`` is the tokenizer file's place on every executor."""

    def factory():
        encoder = load_encoder(path)

        def compute(texts):
            return [_coded(encoder, texts)]

        compute.close = encoder.forget
        return compute

    return with_text_columns(df, text_col, [T.StructField(ids, T.ArrayType(T.IntegerType()))], factory)


def round_trip(df: DataFrame, path: str, text_col: str = "text", ids: str = "ids", out: str = "decoded", surface: bool = True, load_encoder: Callable[[str], Encoder] = load) -> DataFrame:
    """df with what ``encode_texts`` and then ``decode_ids`` add. A task has one Python worker for both, not two that each hold the merges and a batch."""

    def factory():
        encoder = load_encoder(path)
        machine = (SurfaceDecoder if surface else TextDecoder)(encoder.m)

        def compute(texts):
            coded = _coded(encoder, texts)
            return [coded, _decoded(machine, coded)]

        compute.close = encoder.forget
        return compute

    return with_text_columns(df, text_col, [T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(out, T.StringType())], factory)


def decode_ids(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded", surface: bool = True) -> DataFrame:
    """df with ``out``: the ids' text, by SurfaceDecoder (as the library) or TextDecoder. Null ids give an empty text."""
    kept = [c for c in df.columns if c != out]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(out, T.StringType())])
    at = kept.index(ids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = None
        for batch in batches:
            machine = machine or (SurfaceDecoder if surface else TextDecoder)(load(path).m)
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                yield pa.RecordBatch.from_arrays([*part.columns, _decoded(machine, part.column(at))], [*kept, out])
        released_memory()

    return df.select(*[df[f"`{c}`"] for c in kept]).mapInArrow(work, schema)
