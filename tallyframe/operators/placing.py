"""Words placed in rows and columns of their pages in Python workers, all words of a batch at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T

from tallyframe.operators import reader

CELL = T.StructType([T.StructField("row_ix", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("text", T.StringType())])


def _rows(lists: list[pa.Array], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, row of its page) of the words by page, row, x0, word_ix and text, as ``layout.row_clusters`` tells rows."""
    page = np.repeat(np.arange(len(counts)), counts)
    ix, text, x0, x1, top, bottom = lists
    numbers = [c.to_numpy(zero_copy_only=False) for c in (ix, x0, top, bottom)]
    if any(c.null_count for c in (ix, x0, top, bottom)) or not all(np.isfinite(n).all() for n in numbers):
        return _careful_rows(lists, counts)
    i, x, t, b = numbers
    middle, height = (t + b) / 2, b - t
    if not (np.isfinite(middle).all() and np.isfinite(height).all()):
        return _careful_rows(lists, counts)
    order, opens = reader.row_starts(middle, height, page, counts, x, i)
    row = np.cumsum(opens) - 1
    again = np.lexsort((i[order], x[order], row))
    same = lambda a: a[1:] == a[:-1]
    if (same(row) & same(x[order][again]) & same(i[order][again])).any():
        rank = pc.rank(text, null_placement="at_start", tiebreaker="dense").to_numpy()
        again = np.lexsort((rank[order], i[order], x[order], row))
    return order[again], row - row[np.cumsum(counts) - counts][page]


def _careful_rows(lists: list[pa.Array], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same where words have nulls, NaN or infinities."""
    ix, text, x0, x1, top, bottom = (c.to_pylist() for c in lists)
    order, row, start = [], [], 0
    for n in counts.tolist():
        own = range(start, start + n)
        words = [(None if top[k] is None or bottom[k] is None else (top[k] + bottom[k]) / 2, x0[k], ix[k], x1[k], str(k), None if top[k] is None or bottom[k] is None else bottom[k] - top[k]) for k in own]
        for r, (_, placed) in enumerate(reader.rows_of(words, False)):
            ks = sorted((int(w[2]) for w in placed), key=lambda k: tuple(reader._ordered(y) for y in (x0[k], ix[k], text[k])))
            order += ks
            row += [r] * len(ks)
        start += n
    return np.array(order), np.array(row)


def _columns(heads: list[tuple]) -> list[tuple]:
    """(left, right, kind) of heads (x0, x1, kind), as ``layout.column_bounds`` tells them."""
    o = sorted(heads, key=reader._by(0, 2))
    middle = lambda a, b, end: end if a is None or b is None else (a + b) / 2
    return [(0.0 if i == 0 else middle(o[i - 1][1], x0, 0.0), float("inf") if i == len(o) - 1 else middle(x1, o[i + 1][0], float("inf")), kind) for i, (x0, x1, kind) in enumerate(o)]


def _holds(left: float, right: float, centre: np.ndarray) -> np.ndarray:
    """Whether [left, right) holds each centre; NaN is the largest number, as in Spark, and stands for a null in centres too, which nothing holds."""
    return (centre >= left) & ((centre < right) | (right != right))


def cell_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of packed words (page, word_ix, text, x0, x1, top, bottom, head), a page's runs beside each other, to cells: page and CELL."""
    for batch in reader.whole_pages(batches, 1):
        starts = reader._changes(batch.column(0))
        *lists, head = [c.flatten() for c in batch.columns[1:]]
        counts = np.add.reduceat(pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False), starts)
        order, row = _rows(lists, counts)
        page = np.repeat(np.arange(len(counts)), counts)
        x0, x1 = (lists[k].to_numpy(zero_copy_only=False)[order] for k in (2, 3))
        centre, column, kinds = (x0 + x1) / 2, np.full(len(order), -1), []
        heading = np.flatnonzero(head.is_valid().to_numpy(zero_copy_only=False)[order] & (row == 0))
        at = pa.array(order[heading])
        told = list(zip(*(c.take(at).to_pylist() for c in (lists[2], lists[3], head))))
        ends = np.cumsum(counts)
        cuts = reader._changes(pa.array(page[heading])) if len(heading) else []
        for a, b in zip(cuts, [*cuts[1:], len(heading)]):
            k = int(page[heading[a]])
            words = slice(int(ends[k] - counts[k]), int(ends[k]))
            own = _columns(told[a:b])
            names = {kind: len(kinds) + i for i, kind in enumerate(dict.fromkeys(c[2] for c in own))}
            kinds += names
            edges = [c[0] for c in own]
            if all(p[0] < p[1] == q[0] for p, q in zip(own, own[1:])):
                code = np.array([-1, *[names[c[2]] for c in own]])
                place = np.searchsorted(edges, centre[words], "right")
                found = np.where(centre[words] < own[-1][1], code[place], -1)
            else:
                found = np.full(words.stop - words.start, -1)
                for left, right, kind in reversed(own):  # the leftmost counts
                    found[_holds(left, right, centre[words])] = names[kind]
            column[words] = found
        kept = np.flatnonzero((column >= 0) & (row > 0))
        if not len(kept):
            continue
        kept = kept[np.lexsort((column[kept], row[kept], page[kept]))]
        where = np.stack([page[kept], row[kept], column[kept]])
        first = np.flatnonzero(np.concatenate([[True], (where[:, 1:] != where[:, :-1]).any(axis=0)]))
        text = lists[1].take(pa.array(order[kept]))
        if text.null_count:
            all_texts, stops = text.to_pylist(), [*first.tolist(), len(kept)]
            joined = pa.array([" ".join([t for t in all_texts[a:b] if t is not None]) for a, b in zip(stops, stops[1:])], text.type)
        else:
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([*first, len(kept)], pa.int32()), text), " ")
        own = where[:, first]
        pages = batch.column(0).take(pa.array(np.array(starts)[own[0]]))
        yield pa.RecordBatch.from_arrays([pages, pa.array(own[1], pa.int32()), pa.array(kinds, head.type).take(pa.array(own[2])), joined], [batch.schema.names[0], *CELL.names])
