"""Benchmark decontamination with a generalised suffix automaton.

The words of the benchmark items, read one item after the other, form one automaton
over word numbers that accepts every substring of every item. Documents stream through
it: the longest match that ends at each word is tracked, and the words under a match
that is long enough (13 words, or a whole shorter item) are marked. An automaton is
built, in a task, from a bounded number of words (``shard_words``); a larger benchmark
gives several. They are broadcast one by one, and documents pass once: some megabytes of texts
are cut into words and shown to one automaton after the other, of which a task holds one.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tremora.llm.common import id_text, materialise, slices, utf8_texts

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WINDOW = 13
COVERAGE = 20  # contaminated if hit words make up a 20th of all words
SHARD_WORDS = 400_000
_TOGETHER = 1 << 24  # bytes of texts shown to one automaton before the next


def words_of(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())  # of bytes, lower() changes A-Z only


class Automaton:
    """Suffix automaton of several word sequences; states are numbered from the root 0."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.len = [0]

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.len.append(length)
        return len(self.len) - 1

    def _split(self, p: int, q: int, w: int) -> int:
        """The part of state q whose strings end in a step by w from p."""
        clone = self._state(self.len[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def extend(self, last: int, w: int) -> int:
        """Append word w to the sequence that ends in state ``last``; the state it then ends in."""
        q = self.next[last].get(w)
        if q is not None:  # known from an earlier sequence
            return q if self.len[q] == self.len[last] + 1 else self._split(last, q, w)
        cur, p = self._state(self.len[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._split(p, q, w)
        return cur

    def walk(self, ids: Iterable[int]) -> Iterator[tuple[int, int]]:
        """State and length of the longest match that ends at each word."""
        state, length = 0, 0
        for w in ids:
            while state and w not in self.next[state]:
                state = self.link[state]
                length = self.len[state]
            if w in self.next[state]:
                state = self.next[state][w]
                length += 1
            yield state, length


@dataclass
class Index:
    """What a task needs to find the windows of some items in a text."""

    vocabulary: dict[bytes, int]
    automaton: Automaton
    window_of: list[int]  # state -> the state of its last WINDOW words, -1 where it has fewer
    items: dict[int, list[str]]  # such a state -> ids of the items that hold the window
    short: dict[int, list[tuple[int, str]]]  # state -> whole items of under WINDOW words that end it: (words, id)
    least: int  # words of the shortest window


def build_index(items: Iterable[tuple[str, bytes]], window: int = WINDOW) -> Index | None:
    """Index of (id, text) items; None if no item has a word."""
    vocabulary: dict[bytes, int] = {}
    auto = Automaton()
    coded = []
    for item, text in items:
        ids = [vocabulary.setdefault(w, len(vocabulary)) for w in words_of(text)]
        if ids:
            coded.append((item, ids))
            last = 0
            for w in ids:
                last = auto.extend(last, w)
    if not coded:
        return None
    order = np.argsort(auto.len, kind="stable").tolist()  # links lead to shorter strings
    window_of = [-1] * len(auto.len)
    for s in order[1:]:
        if auto.len[s] >= window:
            up = auto.link[s]
            window_of[s] = s if auto.len[up] < window else window_of[up]
    found: dict[int, set[str]] = {}
    ends: dict[int, list[tuple[int, str]]] = {}
    for item, ids in coded:
        steps = list(auto.walk(ids))
        if len(ids) < window:
            ends.setdefault(steps[-1][0], []).append((len(ids), item))
        for state, length in steps:
            if length >= window:
                found.setdefault(window_of[state], set()).add(item)
    short: dict[int, list[tuple[int, str]]] = {}
    if ends:
        for s in order[1:]:
            got = ends.get(s, []) + short.get(auto.link[s], [])
            if got:
                short[s] = got
    return Index(vocabulary, auto, window_of, {k: sorted(v) for k, v in found.items()}, short,
                 min(window, min(len(ids) for _, ids in coded)))


def find_hits(words: list[bytes], index: Index, window: int = WINDOW) -> tuple[list[tuple[int, int]], set[str]]:
    """Hit spans (first word, end) of a text, merged and in order, and the items that occur.

    A word outside the vocabulary ends every match, so only runs of known words that
    are as long as the shortest window enter the automaton.
    """
    known = index.vocabulary.get
    ids = np.fromiter((known(w, -1) for w in words), np.int64, len(words))
    edges = np.flatnonzero(np.diff(np.concatenate([[False], ids >= 0, [False]]).astype(np.int8)))
    spans: list[tuple[int, int]] = []
    items: set[str] = set()

    def mark(a: int, b: int) -> None:
        while spans and spans[-1][1] >= a:  # ends come in order, starts need not
            a = min(a, spans.pop()[0])
        spans.append((a, b))

    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if b - a < index.least:
            continue
        for i, (state, length) in enumerate(index.automaton.walk(ids[a:b].tolist()), a + 1):
            if length >= window:
                mark(i - window, i)
                items.update(index.items[index.window_of[state]])
            if state in index.short:
                for n, item in index.short[state]:
                    if n <= length:
                        mark(i - n, i)
                        items.add(item)
    return spans, items


def find_all(texts: Iterable[bytes], indexes: Iterable[Index], window: int = WINDOW) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
    """(words, merged hit spans, items) of each text, by one index after the other."""
    found: list[tuple[list[bytes], list[tuple[int, int]], set[str]]] = [(words_of(t), [], set()) for t in texts]
    many = 0
    for many, index in enumerate(indexes, 1):
        for words, spans, items in found:
            own, names = find_hits(words, index, window)
            spans += own
            items |= names
    return [(len(words), spans if many < 2 else _merged(spans), sorted(items)) for words, spans, items in found]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


class Indexes:
    """Pickled indexes as broadcast variables, of which a task holds one at a time (a single one it keeps)."""

    def __init__(self, sent: list[Broadcast]) -> None:
        self.sent, self.kept = sent, None

    def __iter__(self) -> Iterator[Index]:
        for one in self.sent:
            index = self.kept or pickle.loads(one.value)
            if len(self.sent) == 1:
                self.kept = index
            vars(one).pop("_value", None)  # it is read from the executor's file when it is asked for again
            yield index

    def __reduce__(self) -> tuple:
        return Indexes, (self.sent,)


def index_shards(benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(shard, index): pickled indexes of about ``shard_words`` words of items each (one item at least), built in tasks. Stored.

    Items without id are left out; items that repeat an id count as that one item; null texts have no words.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.coalesce("text", F.lit("")).alias("text")).where("item is not null")
    words = items.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")))).first()[0] or 0
    shards = -(-words // shard_words)

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []

        def done() -> Iterator[pa.RecordBatch]:
            index = build_index(held, window) if held else None
            if index:
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([cloudpickle.dumps(index)], pa.binary())], names=["shard", "index"])

        for b in batches:
            for own, item, text in zip(b.column("shard").to_pylist(), b.column("item").to_pylist(), utf8_texts(b)):
                if own != shard:
                    yield from done()
                    shard, held = own, []
                held.append((item, text))
        yield from done()

    dealt = items.withColumn("shard", F.pmod(F.xxhash64("item"), F.lit(max(1, shards))))
    dealt = dealt.repartition(max(1, shards), "shard").sortWithinPartitions("shard", "item", "text")
    return materialise(dealt.mapInArrow(build, "shard long, index binary"), "benchmark-index")


def send_indexes(benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> Indexes:
    """The indexes as broadcast variables; the driver holds one at a time."""
    spark = benchmark.sparkSession
    rows = index_shards(benchmark, window, shard_words).select("index").toLocalIterator()
    return Indexes([spark.sparkContext.broadcast(bytes(r["index"])) for r in rows])


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS,
                       row: str | None = None) -> DataFrame:
    """doc_id, n_words, starts, ends, items: merged hit spans, in words, of every row of ``docs``, in one pass.

    Null texts and items have no words. ``row`` names a column that comes back as it is.
    """
    indexes = send_indexes(benchmark, window, shard_words)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       *([F.col(row).alias("row")] if row else []))
    kept = [f for f in rows.schema if f.name != "text"]
    schema = StructType([*kept, *StructType.fromDDL("n_words long, starts array<int>, ends array<int>, items array<string>")])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", _TOGETHER):
                found = find_all(utf8_texts(b), indexes, window)
                arrays = [b.column(f.name) for f in kept] + [
                    pa.array([n for n, _, _ in found], pa.int64()), pa.array([[a for a, _ in x] for _, x, _ in found], pa.list_(pa.int32())),
                    pa.array([[e for _, e in x] for _, x, _ in found], pa.list_(pa.int32())), pa.array([i for _, _, i in found], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return rows.mapInArrow(run, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: int = COVERAGE,
                  shard_words: int = SHARD_WORDS, row: str | None = None) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of ``docs``.

    A text is contaminated if it has hit words and they are at least one in ``coverage``.
    A null or empty text, or one without words, has no hits. Rows are judged one by one;
    ``row`` names a column that comes back with them, as ``row``.
    """
    hit = F.aggregate(F.zip_with("starts", "ends", lambda a, e: (e - a).cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)
    return contaminated_spans(docs, benchmark, window, shard_words, row).withColumn("n_hit", hit).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array("items")), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * coverage >= F.col("n_words"))).alias("contaminated"), *(["row"] if row else []),
    )


def strip_spans(raw: bytes, spans: list[tuple[int, int]], coverage: int = COVERAGE) -> bytes | None:
    """The text without its hit words, or None if they make up a ``coverage``-th of it or more.

    What stands between the words of a span goes with it; the rest is left as it is.
    """
    if not spans:
        return raw
    at = [m.span() for m in WORD.finditer(raw.lower())]
    if sum(e - a for a, e in spans) * coverage >= len(at):
        return None
    out, last = [], 0
    for a, e in spans:
        out.append(raw[last : at[a][0]])
        last = at[e - 1][1]
    return b"".join([*out, raw[last:]])


def decontaminated_texts(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: int = COVERAGE,
                         shard_words: int = SHARD_WORDS) -> DataFrame:
    """doc_id and the text left, row by row, in one pass: contaminated rows go, shorter hits are cut out of the others.

    A null text stays as an empty one.
    """
    indexes = send_indexes(benchmark, window, shard_words)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", _TOGETHER):
                texts = list(utf8_texts(b))
                left = [strip_spans(t, spans, coverage) for t, (_, spans, _) in zip(texts, find_all(texts, indexes, window))]
                kept = pa.array([t is not None for t in left])
                text = pa.array([t.decode(errors="replace") for t in left if t is not None], pa.string())
                yield pa.RecordBatch.from_arrays([b.column("doc_id").filter(kept), text], names=["doc_id", "text"])

    return id_text(docs).mapInArrow(run, "doc_id long, text string")


ORACLE = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iwords AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM iwords WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, sizes WHERE len(w) >= n)),
found AS (SELECT doc_id, i, n, item_id FROM grams JOIN windows USING (n, g)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit
         FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""
