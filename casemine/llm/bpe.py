"""Byte-pair encoding and decoding with a segment tree over adjacent pairs.

A word starts as one symbol per byte (the last one carries the end-of-word
mark).  Leaf i of the tree holds ``rank << 32 | i`` of the pair that starts at
symbol i, so the root is the lowest rank and, among equals, the leftmost.  A
merge rewrites three leaves (the pair itself, the one it swallowed, the one
before) and their paths to the root, in O(log n); encoding ends when the root
is empty.  A word of n bytes thus costs O(n log n) whatever its length.

Around it, as the vocabulary file asks: special tokens are cut out of the raw
text first, the rest is normalised (NFC, white space runs to one space, lower
case per character) and split by the file's pattern.  Each distinct word is
encoded once per Python worker and kept in a bounded table.

Rows never meet: one ``mapInArrow`` without a shuffle, a slice of rows at a
time.  Edge cases: null text counts as empty (no tokens, empty decoded text);
repeated and null doc_ids are kept as they come, row by row; an empty table
gives an empty result; columns other than the id and text are not read.
"""

from __future__ import annotations

import json
import struct
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_slices

EMPTY = 1 << 62
# Code points that the regex module's newer Unicode tables take
# for letters or numbers and the encoding library takes for unassigned.
NOT_YET_LETTERS = (
    "\u0558\u058b\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce\ua7cf\ua7d2\ua7d4"
    "\ua7dd\ua7e2\ua7f1\uab6c\uab6d\U000107bb-\U000107bf\U00010940-\U00010959"
    "\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb"
    "\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686"
    "\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff"
    "\U00018cd6-\U00018cda\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191"
    "\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6\U0001df1f-\U0001df24"
    "\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de"
    "\U0001e6e0-\U0001e6e2\U0001e6e4\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4"
    "\U0001e6fe\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead"
    "\U000323b0-\U00033479\U0003d000-\U0003fc3f")
# Lower case of capitals that Python's tables don't have yet.
NEW_CAPITALS = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3,
                0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
                **{c: c + 32 for c in range(0x10D50, 0x10D66)},
                **{c: c + 27 for c in range(0x16EA0, 0x16EB9)}}
WORD_TABLE = 500_000  # distinct words kept per worker before the table starts anew
LONGEST_KEPT = 64     # characters of a word that is worth keeping


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: printable Latin-1 stands for itself, the rest in order from
    U+0100 (fixed by the file format)."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


class Bpe:
    """A vocabulary file: ``encode`` a text to ids, ``decode`` ids to text."""

    def __init__(self, path: str):
        import regex
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.tokens = [tokens.get(i, "") for i in range(max(tokens) + 1)]
        self.rank, self.made = {}, []
        for r, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rank.setdefault(vocab[left] << 20 | vocab[right], r)
            self.made.append(vocab[left + right])
        alphabet = byte_alphabet()
        self.inner = [vocab[c] for c in alphabet]
        self.last = [vocab[c + end] for c in alphabet]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        pattern = split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")
        self.words = regex.compile(pattern)
        self.rare = regex.compile(f"[{NOT_YET_LETTERS}{''.join(map(chr, NEW_CAPITALS))}]")
        self.rare_words = regex.compile(
            pattern.replace(r"[^", rf"(?:[{NOT_YET_LETTERS}]|[^").replace(r"\p{N}]+", r"\p{N}])+")
            .replace(r"[\p{L}]", rf"(?:(?![{NOT_YET_LETTERS}])\p{{L}})")
            .replace(r"|[\p{N}]|", rf"|(?![{NOT_YET_LETTERS}])\p{{N}}|"))
        self.cut = regex.compile("|".join(regex.escape(t) for t in self.special))
        self.table = _Words(self)

    def merge(self, word: str) -> list[int]:
        """Ids of one word: merge the root's pair until there is none."""
        raw = word.encode("utf-8", "replace")
        ids = [self.inner[b] for b in raw]
        ids[-1] = self.last[raw[-1]]
        n = len(ids)
        if n == 1:
            return ids
        rank, made = self.rank.get, self.made
        size = 1 << (n - 2).bit_length()
        tree = [EMPTY] * (2 * size)
        for i in range(n - 1):
            r = rank(ids[i] << 20 | ids[i + 1])
            if r is not None:
                tree[size + i] = r << 32 | i
        for p in range(size - 1, 0, -1):
            a, b = tree[2 * p], tree[2 * p + 1]
            tree[p] = a if a < b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        root = tree[1]
        while root != EMPTY:
            i, new = root & 0xFFFFFFFF, made[root >> 32]
            j = after[i]
            k, h = after[j], before[i]
            ids[i], ids[j], after[i] = new, -1, k
            changed = []
            if k < n:
                before[k] = i
                changed.append((size + j, EMPTY))
                r = rank(new << 20 | ids[k])
                changed.append((size + i, EMPTY if r is None else r << 32 | i))
            else:
                changed.append((size + i, EMPTY))
            if h >= 0:
                r = rank(ids[h] << 20 | new)
                changed.append((size + h, EMPTY if r is None else r << 32 | h))
            for p, value in changed:
                while tree[p] != value:
                    tree[p] = value
                    if p == 1:
                        break
                    a, p = tree[p ^ 1], p >> 1
                    if a < value:
                        value = a
            root = tree[1]
        return [x for x in ids if x >= 0]

    def _plain(self, text: str) -> bytes:
        # the file also turns white space runs into one blank; no word holds any
        text = unicodedata.normalize("NFC", text)
        pattern, rare = self.words, not _latin(text) and self.rare.search(text)
        if rare:
            pattern, text = self.rare_words, text.translate(NEW_CAPITALS)
        text = text.replace("Σ", "σ").lower()  # per character: no final sigma
        return b"".join(map(self.table.__getitem__, pattern.findall(text)))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += [self._plain(text[at:m.start()]), self.special[m[0]].to_bytes(4, "little")]
            at = m.end()
        out.append(self._plain(text[at:] if at else text))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Token strings of the ids, with blanks between (the file names no
        decoder that would join them otherwise)."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def _latin(text: str) -> bool:
    """Whether all characters are below U+0100."""
    try:
        text.encode("latin-1")
        return True
    except UnicodeEncodeError:
        return False


class _Words(dict):
    """Ids of words as little-endian 32-bit integers, found on first use."""

    def __init__(self, bpe: Bpe):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, word: str) -> bytes:
        ids = self.bpe.merge(word)
        got = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= LONGEST_KEPT:
            if len(self) >= WORD_TABLE:
                self.clear()
            self[word] = got
        return got


@lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    """One vocabulary per Python worker."""
    return Bpe(path)


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
           decoded: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit integers) and,
    if asked for, ``decoded`` (the text that the ids decode to) per row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batch: pa.RecordBatch) -> dict:
        bpe = load(path)
        ids = [bpe.encode(t) if t else b"" for t in batch.column(1).to_pylist()]
        out = {"doc_id": batch.column(0), "n_tokens": [len(x) // 4 for x in ids], "ids": ids}
        if decoded:
            out["decoded"] = [bpe.decode(x) for x in ids]
        return out

    schema = "doc_id long, n_tokens long, ids binary" + ", decoded string" * decoded
    return map_slices(rows, run, schema)


def decode(frame: DataFrame, path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id, decoded`` of a frame with ids as ``encode`` writes them."""
    rows = frame.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).alias("ids"))
    return map_slices(rows, lambda b: {
        "doc_id": b.column(0), "decoded": [load(path).decode(x or b"") for x in b.column(1).to_pylist()]},
        "doc_id long, decoded string", text="ids")
