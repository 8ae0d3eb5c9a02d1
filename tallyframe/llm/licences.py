"""Licence scan: Aho-Corasick over identifier tags and notice phrases, shunting-yard over licence expressions.

A text becomes its folded words with one space between them, and one automaton finds every phrase in one
pass. Where the words ``spdx license identifier`` stand, the expression behind the tag is read from the raw
text up to the end of its line, turned to postfix order by the shunting-yard rule (WITH binds before AND,
AND before OR) and evaluated to its alternatives: a set of sets of licences.

Score: 1 - product of (1 - weight) over the kinds of evidence found, so 0 without any and below 1 always:
a tag whose expression parses weighs 0.9, a base phrase 0.7, another notice phrase 0.5.

Cases: a null or empty text has no words, no places, empty labels and score 0; a broken expression counts
as the licences it names, without alternatives; one of over 256 alternatives counts in full, but they are not listed; repeated phrases count once for labels and each for places.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyframe.llm.arrowmap import with_text_columns
from tallyframe.llm.bytewords import FOLD_TABLE

#: Phrases that the contract names.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Openings of public licence notices.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license version 2": "mpl-2",
    "boost software license version 1": "bsl-1",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "cc by sa": "cc-by-sa",
    "cc0 1 0 universal": "cc0",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
TAG = "spdx license identifier"
#: Identifiers that have a label of their own here; any other identifier is its own label.
IDENTIFIERS = {"mit": "mit", "apache-2.0": "apache-2", "apache-2": "apache-2", "cc-by-nc-4.0": "cc-by-nc", "cc-by-nc-3.0": "cc-by-nc", "cc-by-sa-4.0": "cc-by-sa", "gpl-2.0": "gpl-2", "gpl-2.0-only": "gpl-2", "gpl-2.0-or-later": "gpl-2", "gpl-3.0": "gpl-3", "gpl-3.0-only": "gpl-3", "gpl-3.0-or-later": "gpl-3", "mpl-2.0": "mpl-2", "isc": "isc", "bsd-2-clause": "bsd", "bsd-3-clause": "bsd", "cc0-1.0": "cc0", "unlicense": "unlicense"}
WEIGHT = {"tag": 0.9, "base": 0.7, "notice": 0.5}

_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.+\-]*")
_RANK = {"or": 1, "and": 2, "with": 3}
_EXPRESSION = re.compile(rb"[^A-Za-z0-9(\r\n]*([A-Za-z0-9(][A-Za-z0-9.+\-() \t]*)")


class ExpressionError(ValueError):
    pass


def postfix(expression: str) -> list[str]:
    """The expression's operands and operators in postfix order (shunting-yard)."""
    out: list[str] = []
    stack: list[str] = []
    operand_due = True
    for token in _TOKEN.findall(expression):
        low = token.lower()
        if low in _RANK:
            if operand_due:
                raise ExpressionError(f"{token} without a left side")
            while stack and stack[-1] != "(" and _RANK[stack[-1]] >= _RANK[low]:
                out.append(stack.pop())
            stack.append(low)
            operand_due = True
        elif token == "(":
            if not operand_due:
                break
            stack.append("(")
        elif token == ")":
            if operand_due or "(" not in stack:
                raise ExpressionError("unbalanced )")
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        else:
            if not operand_due:
                break  # prose after the expression
            out.append(low.rstrip("."))
            operand_due = False
    if operand_due or "(" in stack:
        raise ExpressionError("unfinished expression")
    return out + stack[::-1]


def _operand(token: str) -> str:
    return IDENTIFIERS.get(token.rstrip("+"), token)


def named(expression: str) -> set[str]:
    """The labels of all alternatives of an expression, however many these are."""
    values: list[set[str]] = []
    for token in postfix(expression):
        if token not in _RANK:
            values.append({_operand(token)})
            continue
        right = values.pop()
        if token == "with":
            exception = "+".join(sorted(right))
            values[-1] = {f"{x}-with-{exception}" for x in values[-1]}
        else:
            values[-1] |= right
    return values[0]


def alternatives(expression: str, most: int = 256) -> frozenset[frozenset[str]]:
    """The sets of licences any one of which satisfies the expression; over ``most`` of them are an error."""
    values: list[frozenset[frozenset[str]]] = []
    for token in postfix(expression):
        if token not in _RANK:
            values.append(frozenset([frozenset([_operand(token)])]))
            continue
        right, left = values.pop(), values.pop()
        if token == "or":
            made = left | right
        elif token == "and":
            made = frozenset(a | b for a in left for b in right)
        else:
            exception = "+".join(sorted(x for a in right for x in a))
            made = frozenset(frozenset(f"{x}-with-{exception}" for x in a) for a in left)
        if len(made) > most:
            raise ExpressionError("too many alternatives")
        values.append(made)
    return values[0]


@dataclass
class Found:
    n_words: int = 0
    places: list[tuple[int, str]] = field(default_factory=list)
    notices: list[tuple[int, str]] = field(default_factory=list)
    expressions: list[str] = field(default_factory=list)
    choices: list[list[str]] = field(default_factory=list)
    labels: set[str] = field(default_factory=set)
    tagged: bool = False

    def score(self) -> float:
        left = 1.0
        for kind, has in (("tag", self.tagged), ("base", self.places), ("notice", self.notices)):
            left *= 1 - WEIGHT[kind] if has else 1.0
        return round(1 - left, 6)


class Scanner:
    def __init__(self, base: dict[str, str] | None = None, notices: dict[str, str] | None = None):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for kind, phrases in (("notice", NOTICES if notices is None else notices), ("base", BASE if base is None else base), ("tag", {TAG: ""})):
            for phrase, label in phrases.items():
                key = f" {phrase} "
                self.automaton.add_word(key, (kind, label, len(key)))
        self.automaton.make_automaton()

    def scan(self, text: bytes) -> Found:
        words = text.translate(FOLD_TABLE).split()
        out = Found(len(words))
        joined = b" " + b" ".join(words) + b" "
        hits = sorted((end + 1 - n, kind, label) for end, (kind, label, n) in self.automaton.iter(joined.decode("latin-1")))
        spaces = upto = 0
        tags = []
        for at, kind, label in hits:
            spaces += joined.count(b" ", upto, at)
            upto = at
            if kind == "base":
                out.places.append((spaces, label))
            elif kind == "notice":
                out.notices.append((spaces, label))
            else:
                tags.append(spaces)
        out.labels.update(label for _, label in out.places + out.notices)
        if tags:
            self._tags(text, tags, out)
        return out

    def _tags(self, text: bytes, tags: list[int], out: Found) -> None:
        ends, folded = [], text.translate(FOLD_TABLE)
        ends = [m.end() for m in re.finditer(rb"[^ ]+", folded)]
        for first in tags:
            got = _EXPRESSION.match(text, ends[first + 2])
            if not got:
                continue
            expression = got[1].decode("ascii").strip()
            out.expressions.append(expression)
            try:
                names = named(expression)
            except ExpressionError:
                out.labels.update(IDENTIFIERS[x] for x in (t.lower().rstrip(".+") for t in _TOKEN.findall(expression)) if x in IDENTIFIERS)
                continue
            out.tagged = True
            out.labels |= names
            try:
                sets = alternatives(expression)
            except ExpressionError:
                continue  # too many to list
            out.choices += sorted("+".join(sorted(x)) for x in sets) and [sorted("+".join(sorted(x)) for x in sets)]


FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("places", T.ArrayType(T.StructType([T.StructField("word", T.LongType()), T.StructField("label", T.StringType())]))),
    T.StructField("labels", T.ArrayType(T.StringType())),
    T.StructField("expressions", T.ArrayType(T.StringType())),
    T.StructField("choices", T.ArrayType(T.ArrayType(T.StringType()))),
    T.StructField("score", T.DoubleType()),
]


def scan_licences(df: DataFrame, text_col: str = "text", base: dict[str, str] | None = None, notices: dict[str, str] | None = None) -> DataFrame:
    """df with n_words, places (word index and label of base phrases), labels, expressions, choices and score.

    choices: for each parsed expression its alternatives, each a +-joined set of licences. One pass, no shuffle.
    """

    def factory():
        scanner = Scanner(base, notices)

        def compute(texts):
            found = [scanner.scan(x) for x in texts]
            return (
                [f.n_words for f in found],
                [[{"word": w, "label": x} for w, x in f.places] for f in found],
                [sorted(f.labels) for f in found],
                [f.expressions for f in found],
                [f.choices for f in found],
                [f.score() for f in found],
            )

        return compute

    return with_text_columns(df, text_col, FIELDS, factory)
