"""Ranked lexical search by best positions.

Each term of a query has an impact list: the documents that hold it, by falling impact. A search accesses every
list directly at its best position: all places before it have been seen, by sorted or by random access. The document
found there is scored at once by random accesses to the other lists, whose places for it then count as seen, too, so
best positions move past them. No unseen document can score above the sum of the impacts at the best positions. The
search ends when that sum is strictly below the k-th score, since an equal score may still win by its id. Accesses are
made in blocks that double.

Documents are read once. Only the terms of the queries are kept: a document becomes its length and the
counts of these terms. Statistics are counted over all documents. Consecutive documents form shards of at most
SHARD_POSTINGS postings with lists of their own; a task carries the k best from shard to shard as the score to
beat, and the best of all tasks are ranked per query. Queries are taken in blocks of about BLOCK_TERMS terms, each with
a pass of its own, so that what is sent to the tasks is bounded.

Scores: a term's weight is floor(1000 * ln((2N + 2) / (2df + 1))), times its count in the query; a document's m is
100 - 75 + (75 * n * N) div L; a posting's impact is (1000000000 * tf) div (1000 * tf + 8 * m).

Defined results: a text without terms (null among them) is no document for N and is never found; a query without
terms finds nothing. Rows that share a query id are one query with the terms of all of them. Documents that share an id
are ranked each for itself; of equal scores the smaller id comes first, a null id last.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from fareflow.llm.common import arrow_map, pick
from fareflow.sources.tables import RunFolder

#: Fixed value: the bytes of terms in UTF-8, which is all of them beyond ASCII.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xFF]+")
BLOCK_TERMS = 500_000
SHARD_POSTINGS = 1_000_000
SHARD_DOCS = 50_000
FIRST_ACCESSES = 4


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text; A-Z alone are lower-cased."""
    return TERM.findall((text or b"").lower())


def query_terms(queries: DataFrame) -> DataFrame:
    """item, term (binary), n for every ``queries`` row (item, text)."""
    def work(batches):
        for batch in batches:
            for item, text in zip(batch.column(0), batch.column(1)):
                found = terms(text.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item.as_py()] * len(found), batch.schema.types[0]), pa.array(found, pa.binary())], ["item", "term"])

    rows = arrow_map(queries.select("item", F.col("text").cast("binary")), work, f"item {queries.dtypes[0][1]}, term binary")
    return rows.groupBy("item", "term").agg(F.count(F.lit(1)).alias("n"))


def postings(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc, n (terms in the text) and, for those of the vocabulary, places (in it) and counts, for every ``docs`` row (doc, text)."""
    sent = docs.sparkSession.sparkContext.broadcast({term: i for i, term in enumerate(vocabulary)})

    def work(batches):
        known = sent.value
        for batch in batches:
            n, ends, places, counts = [], [0], [], []
            for text in batch.column(1):
                words = terms(text.as_py())
                found, times = np.unique(np.array([known[w] for w in words if w in known], np.int32), return_counts=True)
                n.append(len(words))
                places.append(found)
                counts.append(times.astype(np.int64))
                ends.append(ends[-1] + len(found))
            offsets = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, kind), *parts])))
                     for kind, parts in ((np.int32, places), (np.int64, counts))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), *lists], ["doc", "n", "places", "counts"])

    return arrow_map(docs.select("doc", F.col("text").cast("binary")), work,
                     f"doc {docs.dtypes[0][1]}, n bigint, places array<int>, counts array<bigint>")


def impacts(counts: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    m = 25 + (75 * lengths * n_docs) // n_terms
    return (1_000_000_000 * counts) // (1000 * counts + 8 * m)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(int(lengths.sum()))


class ImpactLists:
    """The lists of a shard: ``ends`` cuts the postings (term, impact) by document."""

    def __init__(self, ends: np.ndarray, terms: np.ndarray, impact: np.ndarray):
        self.first, self.length = ends[:-1], np.diff(ends)
        self.terms, self.impact = terms, impact
        self.at = np.lexsort((-impact, terms))  # the posting at each place; lists one after the other
        self.place = np.empty_like(self.at)
        self.place[self.at] = np.arange(len(self.at))
        self.doc = np.repeat(np.arange(len(self.length)), self.length)
        self.listed, starts = np.unique(terms[self.at], return_index=True)
        self.bounds = np.append(starts, len(self.at))
        self.n_scored = 0  # by the last search

    def search(self, terms: np.ndarray, weights: np.ndarray, dense: np.ndarray, k: int, to_beat: int):
        """Documents and scores among which all of the k best with ``to_beat`` or more are; ``dense``: zeros, one a term."""
        weights, terms = weights[weights > 0], terms[weights > 0]
        where = np.searchsorted(self.listed, terms)
        there = where < len(self.listed)
        there[there] = self.listed[where[there]] == terms[there]
        where, weights = where[there], weights[there]
        dense[self.listed[where]] = weights
        best, end = self.bounds[where].copy(), self.bounds[where + 1]
        seen = np.zeros(len(self.at), bool)
        scored = np.zeros(len(self.length), bool)
        docs, scores, accesses = np.zeros(0, np.int64), np.zeros(0, np.int64), FIRST_ACCESSES
        to_beat = max(1, to_beat)
        while True:
            open_lists = np.flatnonzero(best < end)
            most = int((weights[open_lists] * self.impact[self.at[best[open_lists]]]).sum())
            if most < to_beat:
                break
            new = self.doc[self.at[ranges(best[open_lists], np.minimum(accesses, end[open_lists] - best[open_lists]))]]
            new = np.unique(new[~scored[new]])
            scored[new] = True
            own = ranges(self.first[new], self.length[new])
            share = dense[self.terms[own]]
            sums = np.concatenate([[0], np.cumsum(share * self.impact[own])])
            until = np.cumsum(self.length[new])
            docs = np.concatenate([docs, new])
            scores = np.concatenate([scores, sums[until] - sums[until - self.length[new]]])
            seen[self.place[own[share > 0]]] = True
            for i in open_lists:
                rest = seen[best[i]:end[i]]
                step = int(rest.argmin())
                best[i] = end[i] if rest[step] else best[i] + step
            if len(scores) > k:
                to_beat = max(to_beat, int(np.partition(scores, -k)[-k]))
                docs, scores = docs[scores >= to_beat], scores[scores >= to_beat]
            elif len(scores) == k:
                to_beat = max(to_beat, int(scores.min()))
            accesses *= 2
        dense[self.listed[where]] = 0
        self.n_scored = int(scored.sum())
        good = scores >= to_beat
        return docs[good], scores[good]


def _kept(found: list[tuple], k: int) -> list[tuple]:
    """The k best (score, doc)."""
    return sorted(found, key=lambda x: (-x[0], x[1] is None, x[1]))[:k]


def _shards(batches):
    """docs, ends, places, counts, n of consecutive documents that have postings."""
    rows, size, docs = [], 0, 0
    for batch in batches:
        batch = batch.filter(pc.greater(pc.list_value_length(batch.column(2)), 0))
        at = 0
        lengths = np.cumsum(pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False))
        while at < batch.num_rows:
            before = int(lengths[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(lengths, before + SHARD_POSTINGS - size, "right")))
            end = min(end, batch.num_rows, at + max(1, SHARD_DOCS - docs))
            rows.append(batch.slice(at, end - at))
            size, docs, at = size + int(lengths[end - 1]) - before, docs + end - at, end
            if size >= SHARD_POSTINGS or docs >= SHARD_DOCS or at < batch.num_rows:
                yield pa.Table.from_batches(rows)
                rows, size, docs = [], 0, 0
    if rows:
        yield pa.Table.from_batches(rows)


def _best_of_tasks(held: DataFrame, queries, n_docs: int, n_terms: int, n_vocabulary: int, k: int, item_type: str):
    """item, doc, score: the k best documents of each task for each of the ``queries`` (item, terms, weights)."""
    sent = held.sparkSession.sparkContext.broadcast(queries)

    def work(batches):
        own, dense = sent.value, np.zeros(n_vocabulary, np.int64)
        best: list[list[tuple]] = [[] for _ in own]
        schema = None
        for shard in _shards(batches):
            schema = shard.schema
            shard = shard.combine_chunks()
            ids = shard.column("doc").to_pylist()
            lists = [shard.column(c).combine_chunks() for c in ("places", "counts")]
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists[0]).to_numpy(zero_copy_only=False))])
            places, counts = (x.flatten().to_numpy() for x in lists)
            lengths = np.repeat(shard.column("n").to_numpy(), np.diff(ends))
            index = ImpactLists(ends, places, impacts(counts, lengths, n_docs, n_terms))
            for i, (_, terms, weights) in enumerate(own):
                to_beat = best[i][-1][0] if len(best[i]) == k else 0
                docs, scores = index.search(terms, weights, dense, k, to_beat)
                if len(docs):
                    best[i] = _kept(best[i] + [(s, ids[d]) for d, s in zip(docs.tolist(), scores.tolist())], k)
        if schema is not None:
            rows = [(item, doc, score) for (item, *_), found in zip(own, best) for score, doc in found]
            items, docs, scores = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, item_kind), pa.array(docs, schema.field("doc").type), pa.array(scores, pa.int64())],
                ["item", "doc", "score"])

    item_kind = pa.int64() if item_type == "bigint" else pa.int32() if item_type == "int" else pa.string()
    return arrow_map(held, work, f"item {item_type}, doc {held.dtypes[0][1]}, score bigint")


def search(
    docs: DataFrame, queries: DataFrame, k: int = 10, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", query_column: str = "text", block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents for every query.

    Query ids are integers or strings.
    """
    run = RunFolder(docs.sparkSession)
    docs = pick(docs, id_column, text_column).toDF("doc", "text")
    asked = run.write("terms", query_terms(pick(queries, item_column, query_column).toDF("item", "text")))
    item_type = asked.dtypes[0][1]
    n_blocks = max(1, -(-asked.count() // block_terms))
    found = None
    for block in range(n_blocks):
        some = asked.where(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == block).toArrow()  # about block_terms rows
        vocabulary = sorted(set(some.column("term").to_pylist()))
        held = run.write(f"postings_{block}", postings(docs, vocabulary))
        n_docs, n_terms = held.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
        held_by = held.select(F.explode("places").alias("place")).groupBy("place").agg(F.count(F.lit(1)).alias("df")).toArrow()
        df = dict(zip(held_by.column("place").to_pylist(), held_by.column("df").to_pylist()))
        weight = {t: (i, math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[i] + 1)))) for i, t in enumerate(vocabulary) if i in df}
        own: dict = {}
        for item, term, n in zip(*(some.column(c).to_pylist() for c in ("item", "term", "n"))):
            if term in weight:
                own.setdefault(item, []).append((weight[term][0], n * weight[term][1]))
        own_queries = [(item, *(np.array(x, np.int64) for x in zip(*sorted(pairs)))) for item, pairs in own.items()]
        best = _best_of_tasks(held, own_queries, n_docs, n_terms or 1, len(vocabulary), k, item_type)
        found = best if found is None else found.unionByName(best)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")
