"""Exact removal of repeated passages with suffix arrays.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier (in
a smaller doc_id, or earlier in the same document) goes.  Suffixes of the whole
corpus can't be sorted in one place, so equal strings are first brought together:

1. Seeds.  Among the ``SEED``-byte grams inside a string, the one with the least
   hash (the leftmost of equals) is the string's seed.  It depends on the
   string alone, so equal strings have equal seeds wherever they are.  The
   strings that share one seed place start next to each other; together they are one
   passage, at most ``2 * LENGTH - SEED`` bytes long.
2. Passages are grouped by seed hash.  Of equal passages (two 64-bit hashes
   and the length) all but the first are repeats, found within each slice of
   rows before the shuffle and between slices after it; only the first ones of a
   seed with several different passages need their bytes compared.  Hot seeds
   (more than ``HOT`` rows) are counted beforehand, and their passages are dealt
   by content, so equal ones still meet and no task gets a seed whole.
3. Those passages are fetched from the documents and dealt by seed.  Each
   bucket gets a suffix array by two-stage sorting: suffixes that are
   smaller than their successors are sorted directly, all others are induced by
   scanning the buckets of first bytes in order, as a suffix that is larger than
   its successor follows that one's order.  Adjacent common prefixes of at least
   ``LENGTH`` bytes join equal strings; all but the first of them are repeats.
   A hot seed (edges of a passage that very many documents share) is not
   brought into one task: its strings are grouped one by one over all tasks.
4. Repeats travel back to their documents as intervals, and the bytes they
   cover are cut out.

What moves is packed into compressed arrays (about 22 bytes for 32 bytes of
text); texts are shuffled by a hash of (doc_id, text), in blocks of about
``BLOCK_BYTES``, never by content, so copies and hot sources spread, and
compressed with their neighbours of the same block.

Edge cases: null text counts as empty; texts below ``LENGTH`` bytes are kept
whole; a null doc_id counts as the largest; rows with the same doc_id are
ordered by the text's hash, and rows with the same doc_id and text are one
document, reported once per row; an empty table gives an empty result; other
columns are only carried when asked for.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import cut, row_slices, slots, text_size

LENGTH = 100
SEED = 32
HOT = 10_000
MOST_HOT = 100_000  # seeds that are told apart; beyond, only hotter ones count as hot
BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20  # text whose seeds make one bucket
BOX_BYTES = 16 << 20
SLICE_BYTES = 16 << 20  # text whose passages collapse before they are dealt
PIECE_BYTES = 2 << 20  # of a long text that are hashed at a time
FINER = 4  # buckets of passages for one bucket of seeds
NO_ID = (1 << 63) - 1
WORDS = -(-LENGTH // 8)

SEEDS = (("h", "<u8"), ("c", "<u8"), ("dk", "<i8"), ("th", "<i8"), ("at", "<i4"), ("n", "u1"))
MARKS = (("dk", "<i8"), ("th", "<i8"), ("lo", "<i4"), ("hi", "<i4"))
WANTED = (("dk", "<i8"), ("th", "<i8"), ("at", "<i4"), ("n", "u1"), ("h", "<u8"))


# packed arrays ---------------------------------------------------------------

def pack(layout, columns: dict, raw: bytes = b"") -> bytes:
    import zstandard as zs
    body = b"".join(np.ascontiguousarray(columns[k], dtype=t).tobytes() for k, t in layout)
    n = len(columns[layout[0][0]])
    return n.to_bytes(4, "little") + zs.ZstdCompressor(level=1).compress(body + raw)


def unpack(layout, payload: bytes) -> tuple[dict, bytes]:
    import zstandard as zs
    n, body, at, out = int.from_bytes(payload[:4], "little"), zs.ZstdDecompressor().decompress(payload[4:]), 0, {}
    for k, t in layout:
        size = n * np.dtype(t).itemsize
        out[k] = np.frombuffer(body, dtype=t, count=n, offset=at)
        at += size
    return out, body[at:]


def unpack_all(layout, payloads) -> dict:
    parts = [unpack(layout, p)[0] for p in payloads]
    return {k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, dtype=t) for k, t in layout}


def split_by(key: np.ndarray, layout, columns: dict):
    """(key, packed columns) for each key value."""
    order = np.argsort(key, kind="stable")
    edges = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]]) if len(key) else []
    for a, b in zip(edges, [*edges[1:], len(key)]):
        rows = order[a:b]
        yield int(key[rows[0]]), pack(layout, {k: columns[k][rows] for k, _ in layout})


# seeds -------------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def string_hashes(raw: np.ndarray) -> dict[int, np.ndarray]:
    """Polynomial hashes of the strings of 1, 2, 4, .. 64 bytes at each place."""
    h, factor, size, out = raw.astype(np.uint64) + np.uint64(1), 0x9E3779B97F4A7C15, 1, {}
    while True:
        out[size] = h
        if size == 64 or len(h) <= size:
            return out
        h = h[:-size] * np.uint64(factor) + h[size:]
        factor, size = (factor * factor * 3 + 2) & 0xFFFFFFFFFFFFFFFF, size * 2


def _whole(h: dict[int, np.ndarray], n: int, length: int) -> np.ndarray:
    """Hashes of the strings of ``length`` bytes, from power-of-two parts."""
    out, at = np.zeros(n - length + 1, dtype=np.uint64), 0
    for size in (64, 32, 16, 8, 4, 2, 1):
        while length - at >= size:
            out = out * np.uint64(0xD6E8FEB86659FD93) + _mix(h[size][at:at + len(out)])
            at += size
    return out


def seeds(raw: np.ndarray) -> dict | None:
    """The passages of a text: seed hash ``h``, content hash ``c``, first start
    ``at`` and number of starts ``n``.  A long text is read piece by piece; the
    strings that start in a piece are looked at there, whole."""
    if len(raw) < LENGTH:
        return None
    parts = [_seeds(raw[p:p + PIECE_BYTES + LENGTH - 1], p) for p in range(0, len(raw) - LENGTH + 1, PIECE_BYTES)]
    return {k: np.concatenate([x[k] for x in parts]) for k in parts[0]} if len(parts) > 1 else parts[0]


def _seeds(raw: np.ndarray, start: int) -> dict:
    size = len(raw)
    h = string_hashes(raw)
    low = _mix(h[SEED])
    place, span = np.arange(len(low), dtype=np.int32), 1
    grams = low
    width = LENGTH - SEED + 1
    while span < width:
        step = min(span, width - span)
        right = low[step:] < low[:-step]
        place = np.where(right, place[step:], place[:-step])
        low = np.where(right, low[step:], low[:-step])
        span += step
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    last = np.r_[first[1:], len(place)] - 1
    whole = _whole(h, size, LENGTH)
    c = _mix(whole[first]) * np.uint64(0x9FB21C651E98DF25) + _mix(whole[last] + (last - first).astype(np.uint64))
    return {"h": grams[place[first]], "c": c, "at": (first + start).astype(np.int32), "n": (last - first + 1).astype(np.uint8)}


def _repeats(s: dict) -> tuple[np.ndarray, np.ndarray]:
    """For passages sorted by seed, content and place: which are the first of
    their content, and which repeat it.  A row given twice is the same passage:
    neither."""
    new = np.r_[True, (s["h"][1:] != s["h"][:-1]) | (s["c"][1:] != s["c"][:-1]) | (s["n"][1:] != s["n"][:-1])]
    first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    same = (s["dk"] == s["dk"][first]) & (s["th"] == s["th"][first]) & (s["at"] == s["at"][first])
    return new, ~new & ~same


def _sorted(s: dict) -> dict:
    order = np.lexsort((s["at"], s["th"], s["dk"], s["n"], s["c"], s["h"]))
    return {k: v[order] for k, v in s.items()}


def _marks_of(s: dict, again: np.ndarray) -> dict:
    return intervals(s["dk"][again], s["th"][again], s["at"][again],
                     s["at"][again].astype(np.int64) + s["n"][again] - 1 + LENGTH)


def _slice_hot(batches, least: int):
    """Seeds with more than ``least`` different passages in a slice of rows, and
    how many: the rows that the slice sends for them."""
    for batch in row_slices(batches, "text", SLICE_BYTES):
        parts = [x for x in (seeds(np.frombuffer(raw or b"", dtype=np.uint8)) for raw in batch.column(0).to_pylist()) if x]
        if parts:
            h, c, n = (np.concatenate([x[k] for x in parts]) for k in ("h", "c", "n"))
            order = np.argsort(h)
            edge = np.flatnonzero(np.r_[True, h[order][1:] != h[order][:-1]])
            size = np.diff(np.r_[edge, len(h)])
            some = order[np.repeat(size > least, size)]  # only these can have as many different ones
            h, c, n = h[some], c[some], n[some]
            order = np.lexsort((n, c, h))
            h, c, n = h[order], c[order], n[order]
            new = np.r_[True, (h[1:] != h[:-1]) | (c[1:] != c[:-1]) | (n[1:] != n[:-1])][:len(h)]
            h, count = np.unique(h[new], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h[count > least].view(np.int64)), pa.array(count[count > least])],
                                             ["h", "n"])


def hot_seeds(rows: DataFrame, total: int, hot: int) -> np.ndarray:
    """Seeds with more than ``hot`` rows, ascending.  A slice names only those
    with more than its share of ``hot``, so a seed that is missed has at most
    ``hot`` rows besides, or one for each slice."""
    least = max(1, hot // math.ceil(max(total, 1) / SLICE_BYTES))
    most = max(hot, total // (SEED * MOST_HOT))
    counts = rows.select("text").mapInArrow(lambda it: _slice_hot(it, least), "h long, n long")
    found = counts.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") > most).orderBy(F.desc("n"), "h")
    return np.sort(np.array([r["h"] for r in found.limit(MOST_HOT).select("h").collect()], dtype=np.int64).view(np.uint64))


def _among(h: np.ndarray, hot: np.ndarray) -> np.ndarray:
    return np.isin(h, hot) if len(hot) else np.zeros(len(h), dtype=bool)


def _seed_rows(batches, buckets: int, blocks: int, hot: np.ndarray):
    """Packed passages by bucket, those of ``hot`` seeds by content.  Equal
    passages of a slice of rows collapse to the first of them here, so a passage
    that a third of all documents share reaches its bucket once per slice; the
    others are marks already, and travel in any bucket."""
    for batch in row_slices(batches, "text", SLICE_BYTES):
        parts = {k: [] for k, _ in SEEDS}
        for dk, th, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
            got = seeds(np.frombuffer(raw or b"", dtype=np.uint8))
            if got:
                for k in ("h", "c", "at", "n"):
                    parts[k].append(got[k])
                parts["dk"].append(np.full(len(got["h"]), dk))
                parts["th"].append(np.full(len(got["h"]), th))
        if parts["h"]:
            s = _sorted({k: np.concatenate(v) for k, v in parts.items()})
            first, again = _repeats(s)
            marks = _marks_of(s, again)
            left = {k: v[first] for k, v in s.items()}
            order = np.lexsort((left["at"], left["th"], left["dk"]))  # packs better by document
            left = {k: v[order] for k, v in left.items()}
            deal = np.where(_among(left["h"], hot), _mix(left["h"] + left["c"]), left["h"])
            rows = [(k, -1, p) for k, p in split_by((deal % np.uint64(buckets)).astype(np.int64), SEEDS, left)]
            rows += [(k % buckets, k, p) for k, p in split_by(_block_of(marks["dk"], marks["th"], blocks), MARKS, marks)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                              pa.array([r[1] for r in rows], pa.int64()),
                                              pa.array([r[2] for r in rows], pa.binary())], ["bucket", "block", "payload"])


# grouping by seed ----------------------------------------------------------

def _block_of(dk: np.ndarray, th: np.ndarray, blocks: int) -> np.ndarray:
    return (dk % blocks + th % blocks) % blocks


def intervals(dk, th, lo, hi) -> dict:
    """Overlapping or touching intervals of a document become one."""
    order = np.lexsort((lo, th, dk))
    dk, th, lo, hi = dk[order], th[order], lo[order].astype(np.int64), hi[order].astype(np.int64)
    if not len(dk):
        return {"dk": dk, "th": th, "lo": lo, "hi": hi}
    doc = np.cumsum(np.r_[False, (dk[1:] != dk[:-1]) | (th[1:] != th[:-1])])
    far = int(hi.max()) + 1
    reach = np.maximum.accumulate(hi + doc * far) - doc * far  # within the document
    new = np.r_[True, (doc[1:] != doc[:-1]) | (lo[1:] > reach[:-1])]
    start = np.flatnonzero(new)
    end = np.r_[start[1:], len(dk)] - 1
    return {"dk": dk[start], "th": th[start], "lo": lo[start], "hi": reach[end]}


def _output(kind: int, key: np.ndarray, layout, columns: dict) -> list[tuple]:
    return [(k, kind, p) for k, p in split_by(key, layout, columns)]


def _rows(rows: list[tuple]) -> pa.Table:
    return pa.table({"block": pa.array([r[0] for r in rows], pa.int64()),
                     "kind": pa.array([r[1] for r in rows], pa.int32()),
                     "payload": pa.array([r[2] for r in rows], pa.binary())})


MARK, FETCH, FETCH_HOT = 0, 1, 2


def _group_seeds(group: pa.Table, blocks: int, hot: int, known: np.ndarray) -> pa.Table:
    """Repeats among equal passages, and which passages to compare; marks that
    were found before pass through.  Of the hot seeds ``known`` before, only
    some passages are here."""
    block = group.column("block").to_numpy()
    payloads = group.column("payload").to_pylist()
    rows = [(int(b), MARK, p) for b, p in zip(block, payloads) if b >= 0]
    s = _sorted(unpack_all(SEEDS, [p for b, p in zip(block, payloads) if b < 0]))
    if not len(s["h"]):
        return _rows(rows)
    new_h = np.r_[True, s["h"][1:] != s["h"][:-1]]
    new, again = _repeats(s)
    marks = _marks_of(s, again)
    run = np.cumsum(new_h) - 1
    kinds = np.bincount(run, weights=new)[run]
    rows += _output(MARK, _block_of(marks["dk"], marks["th"], blocks), MARKS, marks)
    apart = _among(s["h"], known) | (kinds > hot)
    for kind, some in ((FETCH, new & (kinds > 1) & ~apart), (FETCH_HOT, new & apart)):
        want = {k: s[k][some] for k, _ in WANTED}
        rows += _output(kind, _block_of(want["dk"], want["th"], blocks), WANTED, want)
    return _rows(rows)


# passages and suffix arrays ----------------------------------------------

def _texts(boxes: pa.Table) -> dict:
    docs = _unbox(boxes)
    return {(dk, th): raw or b"" for dk, th, raw in
            zip(*(docs.column(k).to_pylist() for k in ("dk", "th", "text")))}


def _fetch(docs: pa.Table, wanted: pa.Table, buckets: int) -> pa.Table:
    """Cut the wanted passages out of a block's texts, dealt by seed."""
    w = unpack_all(WANTED, wanted.column("payload").to_pylist())
    rows = []
    if len(w["h"]):
        texts, bucket = _texts(docs), (w["h"] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.r_[True, bucket[order][1:] != bucket[order][:-1]])
        for a, b in zip(edges, [*edges[1:], len(order)]):
            some = order[a:b]
            raw = b"".join(texts[dk, th][at:at + n - 1 + LENGTH] for dk, th, at, n in
                           zip(*(w[k][some].tolist() for k in ("dk", "th", "at", "n"))))
            rows.append((int(bucket[some[0]]), pack(WANTED, {k: w[k][some] for k, _ in WANTED}, raw)))
    return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int64()),
                     "payload": pa.array([r[1] for r in rows], pa.binary())})


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes at each place as one number, first byte highest."""
    n = len(text) - 7
    out = np.zeros(n, dtype=np.uint64)
    for i in range(8):
        out = out << np.uint64(8) | text[i:i + n]
    return out


def _direct(rows: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Sort suffixes by their first ``LENGTH`` bytes, eight at a time; only
    what is still tied is looked at again."""
    rows = rows[np.argsort(words[rows], kind="stable")]
    key = words[rows]
    new = np.r_[True, key[1:] != key[:-1]] if len(rows) else np.zeros(0, dtype=bool)
    for k in range(1, WORDS):
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        group = np.cumsum(new)[at]
        key = words[rows[at] + 8 * k]
        order = np.lexsort((key, group))
        rows[at] = rows[at[order]]
        key, group = key[order], group[order]
        new[at] = np.r_[True, (key[1:] != key[:-1]) | (group[1:] != group[:-1])] | new[at]
    return rows


def two_stage(text: np.ndarray, active: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Suffix array of the ``active`` places of ``text`` (which starts with 0
    and ends with zeros), in the order of their first ``LENGTH`` bytes.  Every
    active suffix larger than its successor has that successor active too."""
    n = len(text)
    step = np.zeros(n, dtype=np.int16)
    step[:-1] = text[1:].astype(np.int16) - text[:-1]
    # places of a run of equal bytes are as the run's last one
    change = np.where(step != 0, np.arange(n), n - 1)
    change = np.minimum.accumulate(change[::-1])[::-1]
    step[-1] = 1
    smaller = step[change] > 0
    direct = _direct(np.flatnonzero(active & smaller), words)
    ends = np.searchsorted(text[direct], np.arange(257))  # direct is sorted by first byte
    larger = active & ~smaller
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []

    def scan(rows: np.ndarray, byte: int) -> np.ndarray:
        """Induce the suffixes before ``rows``; returns those of this bucket."""
        before = rows - 1
        before = before[larger[before]]
        of = text[before]
        here = before[of == byte]
        later = before[of != byte]
        if len(later):
            of = text[later]
            order = np.argsort(of, kind="stable")
            later, of = later[order], of[order]
            edge = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            for a, b in zip(edge, [*edge[1:], len(of)]):
                induced[of[a]].append(later[a:b])
        return here

    for byte in range(256):
        wave = np.concatenate(induced[byte]) if induced[byte] else np.zeros(0, dtype=np.int64)
        while len(wave):
            out.append(wave)
            wave = scan(wave, byte)
        sorted_here = direct[ends[byte]:ends[byte + 1]]
        if len(sorted_here):
            out.append(sorted_here)
            scan(sorted_here, byte)
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def common_prefixes(rows: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Bytes that each suffix shares with the one before it, up to ``LENGTH``."""
    a, b = rows[:-1], rows[1:]
    shared, going = np.zeros(len(a), dtype=np.int64), np.ones(len(a), dtype=bool)
    for k in range(WORDS):
        x = words[a + 8 * k] ^ words[b + 8 * k]
        equal = np.full(len(a), 8)
        for i in range(8):
            equal = np.where(x >> np.uint64(8 * i), 7 - i, equal)
        shared += np.where(going, equal, 0)
        going &= equal == 8
    return np.minimum(np.r_[0, shared], LENGTH)[:len(rows)]


def repeated_strings(w: dict, raw: bytes) -> dict:
    """Intervals of all strings of the passages that also start earlier."""
    size = w["n"].astype(np.int64) - 1 + LENGTH
    start = np.cumsum(size + 1) - size  # one zero before each passage
    text = np.zeros(int(size.sum()) + len(size) + 8 * WORDS + 8, dtype=np.uint8)
    body = np.frombuffer(raw, dtype=np.uint8)
    where = np.arange(len(body)) + np.repeat(np.arange(1, len(size) + 1), size)
    text[where] = body
    words = _words(text)
    owner = np.full(len(text), -1, dtype=np.int32)
    owner[where] = np.repeat(np.arange(len(size), dtype=np.int32), size)
    offset = np.arange(len(text)) - np.where(owner >= 0, start[owner], 0)
    own = (owner >= 0) & (offset < w["n"][owner])
    # the places after a passage's starts are needed up to the first suffix
    # that is smaller than its successor; at the latest the zero behind it
    rise = np.r_[text[1:] > text[:-1], False]
    rise |= owner < 0
    ahead = np.minimum.accumulate(np.where(rise, np.arange(len(text)), len(text) - 1)[::-1])[::-1]
    edge = np.zeros(len(text) + 1, dtype=np.int32)
    np.add.at(edge, start, 1)
    np.add.at(edge, ahead[start + w["n"] - 1] + 1, -1)
    active = np.cumsum(edge[:-1]) > 0
    active[0] = False
    rows = two_stage(text, active, words)
    rows = rows[own[rows]]
    group = np.cumsum(common_prefixes(rows, words) < LENGTH) if len(rows) else np.zeros(0, dtype=np.int64)
    i = owner[rows]
    dk, th, at = w["dk"][i], w["th"][i], w["at"][i] + offset[rows]
    order = np.lexsort((at, th, dk, group))
    group, dk, th, at = group[order], dk[order], th[order], at[order]
    new = np.r_[True, group[1:] != group[:-1]] if len(group) else np.zeros(0, dtype=bool)
    first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    again = (dk != dk[first]) | (th != th[first]) | (at != at[first])
    return intervals(dk[again], th[again], at[again], at[again] + LENGTH)


def _compare(group: pa.Table, blocks: int) -> pa.Table:
    parts = [unpack(WANTED, p) for p in group.column("payload").to_pylist()]
    w = {k: np.concatenate([p[0][k] for p in parts]) for k, _ in WANTED}
    raw = b"".join(p[1] for p in parts)
    marks = repeated_strings(w, raw)
    return _rows(_output(MARK, _block_of(marks["dk"], marks["th"], blocks), MARKS, marks))


def _strings(docs: pa.Table, wanted: pa.Table) -> pa.Table:
    """Every string of the wanted passages, for seeds that are too hot."""
    w = unpack_all(WANTED, wanted.column("payload").to_pylist())
    texts = _texts(docs) if len(w["h"]) else {}
    rows = [(texts[dk, th][i:i + LENGTH], dk, th, i) for dk, th, at, n in
            zip(*(w[k].tolist() for k in ("dk", "th", "at", "n"))) for i in range(at, at + n)]
    return pa.table({"string": pa.array([r[0] for r in rows], pa.binary()),
                     **{k: pa.array([r[j] for r in rows], pa.int64()) for j, k in ((1, "dk"), (2, "th"), (3, "at"))}})


def _hot_marks(docs: DataFrame, hot: DataFrame, blocks: int) -> DataFrame:
    """Repeats among the strings of hot seeds: one row per string, its first
    place by partial aggregation; the first places of repeated strings come
    back by a join that Spark can split."""
    strings = cut(docs.groupBy("block").cogroup(hot.groupBy("block")).applyInArrow(
        _strings, "string binary, dk long, th long, at long"))
    place = F.struct("dk", "th", "at")
    first = cut(strings.groupBy("string").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
                .where("n > 1").select("string", "first"))
    again = strings.join(first, "string").where(place != F.col("first"))
    block = F.pmod(F.pmod("dk", F.lit(blocks)) + F.pmod("th", F.lit(blocks)), F.lit(blocks))

    def run(batches):
        for batch in batches:
            rows = []
            b, dk, th, at = (batch.column(i).to_numpy() for i in range(4))
            marks = {"dk": dk, "th": th, "lo": at, "hi": at + LENGTH}
            rows = _output(MARK, b, MARKS, marks)
            yield from _rows(rows).to_batches()

    return again.select(block.alias("block"), "dk", "th", "at").mapInArrow(run, "block long, kind int, payload binary")


# rows in boxes ---------------------------------------------------------------

def _box(batches, blocks: int):
    """Rows of one block that lie together become one compressed box."""
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in row_slices(batches, "text", BOX_BYTES):
        table = pa.Table.from_batches([batch])
        block = _block_of(table.column("dk").to_numpy(), table.column("th").to_numpy(), blocks)
        order = np.argsort(block, kind="stable")
        edges = np.flatnonzero(np.r_[True, block[order][1:] != block[order][:-1]])
        names, boxes = [], []
        for a, b in zip(edges, [*edges[1:], len(order)]):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
                writer.write_table(table.take(pa.array(order[a:b])))
            names.append(int(block[order[a]]))
            boxes.append(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(boxes, pa.binary())], ["block", "box"])


def _unbox(boxes: pa.Table) -> pa.Table | None:
    tables = [pa.ipc.open_stream(b).read_all() for b in boxes.column("box").to_pylist()]
    return pa.concat_tables(tables) if tables else None


def _boxed(rows: DataFrame, blocks: int) -> DataFrame:
    return rows.mapInArrow(lambda it: _box(it, blocks), "block long, box binary")


# the operator ----------------------------------------------------------------

def _to_characters(raw: bytes, lo: list[int], hi: list[int]) -> tuple[list[int], list[int]]:
    """Intervals of UTF-8 bytes, widened to whole characters."""
    def start(at: int) -> int:
        """First byte of the character that holds the byte ``at``."""
        back = at
        while back > 0 and at - back < 3 and back < len(raw) and raw[back] & 0xC0 == 0x80:
            back -= 1
        return back

    def size(lead: int) -> int:
        return 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4

    out = [], []
    for a, b in zip(lo, hi):
        first, last = start(a), start(b - 1)
        out[0].append(first if first + size(raw[first]) > a else a)
        out[1].append(min(len(raw), max(b, last + size(raw[last]))))
    return out


def _apply(boxes: pa.Table, marks: pa.Table, schema: pa.Schema, characters: bool) -> pa.Table:
    """Cut the marked intervals out of a block's texts."""
    docs = _unbox(boxes)
    if docs is None:
        return schema.empty_table()
    m = unpack_all(MARKS, marks.column("payload").to_pylist())
    m = intervals(m["dk"], m["th"], m["lo"], m["hi"])
    doc = np.r_[True, (m["dk"][1:] != m["dk"][:-1]) | (m["th"][1:] != m["th"][:-1])] if len(m["dk"]) else []
    edge = np.flatnonzero(doc)
    spans = {(int(m["dk"][a]), int(m["th"][a])): (m["lo"][a:b].tolist(), m["hi"][a:b].tolist())
             for a, b in zip(edge, [*edge[1:], len(m["dk"])])}
    out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
    for dk, th, raw in zip(*(docs.column(k).to_pylist() for k in ("dk", "th", "text"))):
        raw = raw or b""
        lo, hi = spans.get((dk, th), ((), ()))
        if characters:
            lo, hi = _to_characters(raw, lo, hi)
        kept = b"".join(raw[a:b] for a, b in zip([0, *hi], [*lo, len(raw)])) if lo else raw
        for k, v in zip(out, (len(raw), len(raw) - len(kept), len(lo), kept)):
            out[k].append(v)
    columns = {k: pa.array(v, pa.binary() if k == "kept" else pa.int64()) for k, v in out.items()}
    carried = [k for k in docs.column_names if k not in ("dk", "th", "text")]
    return pa.table({**{k: docs.column(k) for k in carried}, **columns})


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: Column | None = None,
          hot: int | None = None, characters: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes) per
    row; ``carry`` is a column of ``docs`` that comes along as ``row``.  With
    ``characters``, a character that loses some of its bytes goes whole."""
    spark = docs.sparkSession
    hot = HOT if hot is None else hot
    raw = F.col(text).cast("binary")
    key = [F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("dk"), F.xxhash64(text).alias("th")]
    total = docs.agg(F.sum(text_size(text))).first()[0] or 0
    blocks = max(slots(spark), math.ceil(total / BLOCK_BYTES))
    buckets = max(1, math.ceil(total / BUCKET_BYTES))
    rows = docs.select(*key, raw.alias("text"))
    placed = docs.select(F.col(doc_id).cast("long").alias("doc_id"), *key, raw.alias("text"),
                         *([carry.alias("row")] if carry is not None else []))
    out = StructType([placed.schema["doc_id"], *([placed.schema["row"]] if carry is not None else []),
                      *StructType.fromDDL("n_bytes long, n_removed long, n_spans long, kept binary")])
    shape = to_arrow_schema(out)

    known = hot_seeds(rows, total, hot)
    grouped = cut(rows.mapInArrow(lambda it: _seed_rows(it, buckets, blocks, known), "bucket long, block long, payload binary")
                  .groupBy("bucket").applyInArrow(lambda g: _group_seeds(g, blocks, hot, known),
                                                  "block long, kind int, payload binary"))
    compact = _boxed(rows.where(F.octet_length("text") >= LENGTH), blocks)
    found = [grouped.where(F.col("kind") == MARK)]
    found.append(compact.groupBy("block").cogroup(grouped.where(F.col("kind") == FETCH).groupBy("block"))
                 .applyInArrow(lambda a, b: _fetch(a, b, buckets * FINER), "bucket long, payload binary")
                 .groupBy("bucket").applyInArrow(lambda g: _compare(g, blocks), "block long, kind int, payload binary"))
    if not grouped.where(F.col("kind") == FETCH_HOT).isEmpty():
        found.append(_hot_marks(compact, grouped.where(F.col("kind") == FETCH_HOT), blocks))
    marks = reduce(DataFrame.unionByName, found)
    return _boxed(placed, blocks).groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(
        lambda a, b: _apply(a, b, shape, characters), out)
