"""Benchmark decontamination with an FM-index per training shard.

Words are runs of ASCII letters, digits and non-ASCII characters after lower-casing A-Z. A window is ``width``
consecutive words of an item; a shorter item, if not empty, is one window. Every occurrence of a window in a document
is found, its words are hit, and overlapping occurrences merge into removal spans.

A shard is a run of documents inside a task. Words that no window holds become the separator symbol, and runs
between separators that are shorter than every window are left out of the index: neither can be part of an occurrence.

Defined results: a null or empty text has no words and is never contaminated; null items count as empty; repeated rows
are judged each by itself; equal items are each counted; other columns of the documents stay as they are, those of the
benchmark are ignored; an empty benchmark finds nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table, written
from .fm_index import FMIndex

WIDTH = 10
SHARD_SYMBOLS = 1 << 20
#: Items are searched for in blocks of about this many bytes of text, so that a task holds a bounded set of windows.
#: Bytes of texts that a task has at hand as words.
SLICE_BYTES = 16 << 20
BLOCK_BYTES = 4 << 20
BREAKS = bytes(i for i in range(128) if not (48 <= i <= 57 or 97 <= i <= 122 or 65 <= i <= 90))
TO_WORDS = bytes.maketrans(BREAKS + bytes(range(65, 91)), b" " * len(BREAKS) + bytes(range(97, 123)))
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
LEAK = "__leak"
RUNS = "array<struct<start:int,end:int>>"
LEAK_TYPE = f"struct<n_words:bigint,item_ids:array<string>,hits:{RUNS},spans:{RUNS}>"
RUNS_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
LEAK_ARROW = pa.struct([("n_words", pa.int64()), ("item_ids", pa.list_(pa.string())), ("hits", RUNS_ARROW), ("spans", RUNS_ARROW)])


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(TO_WORDS).split() if text else []


class Windows:
    """The distinct windows of a block of items, as rows of word numbers from 1 on."""

    def __init__(self, items: list[tuple[str, bytes | None]], width: int):
        self.vocabulary: dict[bytes, int] = {}
        number: dict[tuple[int, ...], int] = {}
        self.items_of: list[set[str]] = []
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for i in range(max(1, len(ids) - width + 1) if ids else 0):
                at = number.setdefault(tuple(ids[i : i + width]), len(number))
                if at == len(self.items_of):
                    self.items_of.append(set())
                self.items_of[at].add(item_id)
        self.lengths = np.array([len(w) for w in number], np.int64)
        self.patterns = np.zeros((len(number), width), np.int64)
        for i, w in enumerate(number):
            self.patterns[i, : len(w)] = w
        self.shortest = int(self.lengths.min(initial=width))


class Shard:
    """Documents gathered for one index."""

    def __init__(self, windows: Windows):
        self.windows, self.size = windows, 1
        self.text, self.doc, self.word = ([np.zeros(1, np.int64)] for _ in range(3))

    def add(self, doc: int, words: list[bytes]) -> None:
        get = self.windows.vocabulary.get
        ids = np.fromiter([get(w, 0) for w in words], np.int64, len(words))
        edge = np.diff(np.concatenate(([0], (ids > 0).view(np.int8), [0])))
        starts, ends = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
        long = ends - starts >= self.windows.shortest
        starts, lengths = starts[long], (ends - starts)[long]
        if not len(starts):
            return
        # Each kept run is followed by one separator.
        size = lengths + 1
        base = np.repeat(np.cumsum(size) - size, size)
        within = np.arange(int(size.sum())) - base
        at = np.repeat(starts, size) + within
        self.text.append(np.where(within < np.repeat(lengths, size), ids[np.minimum(at, len(ids) - 1)], 0))
        self.doc.append(np.full(len(at), doc, np.int64))
        self.word.append(at)
        self.size += len(at)

    def find(self) -> tuple[dict[int, set[str]], dict[int, np.ndarray]]:
        """Items per document, and the numbers of its hit words in order."""
        text, w = np.concatenate(self.text), self.windows
        if len(text) == 1 or not len(w.lengths):
            return {}, {}
        index = FMIndex(text, len(w.vocabulary))
        lo, hi = index.search(w.patterns, w.lengths)
        count = np.maximum(hi - lo, 0)
        which = np.repeat(np.arange(len(count)), count)
        rows = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
        at = index.locate(rows)
        doc, word = np.concatenate(self.doc), np.concatenate(self.word)
        change = np.zeros(len(text) + 1, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + w.lengths[which], -1)
        hit = np.nonzero(np.cumsum(change)[:-1] > 0)[0]
        items: dict[int, set[str]] = {}
        for d, p in np.unique(np.stack((doc[at], which), 1), axis=0).tolist():
            items.setdefault(d, set()).update(w.items_of[p])
        hit_doc = doc[hit]
        cuts = np.nonzero(np.diff(hit_doc))[0] + 1
        words = {int(d[0]): x for d, x in zip(np.split(hit_doc, cuts), np.split(word[hit], cuts), strict=True) if len(d)}
        return items, words


def runs(numbers: np.ndarray) -> list[tuple[int, int]]:
    """Merged half-open runs of increasing numbers."""
    if not len(numbers):
        return []
    cuts = np.nonzero(np.diff(numbers) > 1)[0]
    starts = numbers[np.concatenate(([0], cuts + 1))]
    ends = numbers[np.concatenate((cuts, [len(numbers) - 1]))] + 1
    return list(zip(starts.tolist(), ends.tolist(), strict=True))


def without_spans(text: bytes, spans: list[dict]) -> str:
    """The text without these spans of bytes, a line break in place of each."""
    kept, at = [], 0
    for span in spans:
        kept.append(text[at : span["start"]])
        at = span["end"]
    return b"\n".join([*kept, text[at:]]).decode()


def finder(windows, text_at: int, cut: bool = False):
    """Adds a block's findings to the batches' last column, ``LEAK``; ``cut`` takes the spans out of the texts."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, SLICE_BYTES, text_at)):
            before = batch.column(batch.num_columns - 1).to_pylist()
            texts = [None if t is None else t.encode() for t in batch.column(text_at).to_pylist()]
            items, words, shard = {}, {}, Shard(windows.value)
            n_words = []
            for i, text in enumerate(texts):
                found = words_of(text)
                n_words.append(len(found))
                shard.add(i, found)
                if shard.size >= SHARD_SYMBOLS or i == len(texts) - 1:
                    for whole, part in zip((items, words), shard.find(), strict=True):
                        whole.update(part)
                    shard = Shard(windows.value)
            out = []
            for i, (text, old) in enumerate(zip(texts, before, strict=True)):
                hit = [words.get(i, np.empty(0, np.int64)), *(np.arange(h["start"], h["end"]) for h in (old or {}).get("hits", ()))]
                hits = runs(np.unique(np.concatenate(hit)))
                at = [m.span() for m in WORD.finditer(text)] if hits else []
                out.append({
                    "n_words": n_words[i], "item_ids": sorted({*items.get(i, ()), *(old or {}).get("item_ids", ())}),
                    "hits": [{"start": a, "end": b} for a, b in hits], "spans": [{"start": at[a][0], "end": at[b - 1][1]} for a, b in hits]})
            columns = batch.columns[:-1]
            if cut:
                new = [without_spans(text, x["spans"]) if x["spans"] else old for text, x, old in zip(texts, out, columns[text_at].to_pylist(), strict=True)]
                columns[text_at] = pa.array(new, columns[text_at].type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, LEAK_ARROW)], names=batch.schema.names)
    return find


def item_blocks(spark: SparkSession, benchmark: DataFrame, width: int, block_bytes: int):
    """The items in blocks of bounded size, each broadcast as windows when it is its turn, and whether it is the last."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text"))
    # Repeated rows would all meet in one block.
    items = written(items.distinct(), "items")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = total // block_bytes + 1
    for i in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i).collect()
        yield spark.sparkContext.broadcast(Windows([(r[0], r[1]) for r in rows], width)), i == blocks - 1


def find_leaks(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES, cut: bool = False) -> DataFrame:
    """The rows of ``docs`` with a struct column ``LEAK``: n_words, item_ids (sorted), hits (merged runs of hit words) and
    spans (their bytes in the UTF-8 text); with ``cut`` the texts are without them. No shuffle: each block of items is one pass over the rows; further passes,
    which only a very large benchmark needs, read the pass before them from a written table."""
    found, first = docs.withColumn(LEAK, F.lit(None).cast(LEAK_TYPE)), True
    for windows, last in item_blocks(docs.sparkSession, benchmark, width, block_bytes):
        found = (found if first else written(found, "leaks")).mapInArrow(finder(windows, docs.columns.index("text"), cut and last), found.schema)
        first = False
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents with every occurrence of a window cut out of their texts. A document left without a word goes;
    documents without an occurrence stay as they are, byte for byte. Columns are those of ``docs``."""
    found = find_leaks(docs, benchmark, width, block_bytes, cut=True)
    leaks = F.size(f"{LEAK}.spans") > 0
    left = F.col(f"{LEAK}.n_words") > F.aggregate(f"{LEAK}.hits", F.lit(0), lambda a, h: a + h["end"] - h["start"])
    return found.where(~leaks | left).select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")).select("doc_id", f"{LEAK}.*")
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, h: a + h["end"] - h["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower_ascii, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
           FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii FROM documents)),
b AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS k
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM win),
places AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS k
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)),
occ AS (SELECT doc_id, item_id, i, places.n AS n FROM places JOIN win USING (n, k)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM occ)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS all_items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(all_items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
