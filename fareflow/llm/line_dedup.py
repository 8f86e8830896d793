"""Repeated lines dropped through sharded minimal perfect hashes.

1. Every document gives the 128-bit hashes of its long lines; documents are counted per hash, in two
   combining steps so that a line of very many documents meets nowhere as a whole.
2. Frequent hashes are cut into shards of bounded size. For each shard a minimal perfect hash is
   built, which gives every hash of the shard its own place in compact arrays: half of the hash as
   fingerprint, the number of documents, and the largest id.
3. Documents send their hashes to the shards. A task streams them past the arrays of one shard at
   a time; a shard with many probes is copied to several tasks, in proportion to the counts.
   Only the hits travel back to the documents.

Defined results: a null or empty text is one empty line. A null id counts as an id smaller than all
others. Rows that share an id are one document for counting; each row is cut on its own.
Fingerprints have 64 bits besides the place, so foreign lines pass as good as never.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from fareflow.llm.common import arrow_map, mix, pick, ship
from fareflow.sources.tables import RunFolder

BLANKS = " \t\n\x0b\x0c\r"
SHARD_KEYS = 50_000
SHARD_PROBES = 1_000_000
NO_ID = -2 ** 63
ROOM = 1.5


def line_key(line: str, min_chars: int) -> bytes | None:
    """The 128-bit hash of a line's key, or None for a line too short to be dropped."""
    line = line.strip(BLANKS)
    return xxhash.xxh3_128_digest(line.encode().lower()) if len(line) >= min_chars else None


def mixed(values: np.ndarray, level: int) -> np.ndarray:
    """Another pseudorandom number for each value at each level."""
    values = values ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    return mix(values)


class PerfectHash(NamedTuple):
    """Levels of bits. A key's place is the rank of its bit on the first level where it had one alone."""

    sizes: np.ndarray
    bits: np.ndarray  # all levels, one after the other

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys``: distinct unsigned 64-bit numbers."""
        sizes, levels = [], []
        while len(keys):
            size = int(len(keys) * ROOM) + 1
            at = (mixed(keys, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            keys = keys[~alone[at]]
        return cls(np.array(sizes, np.int64), np.concatenate(levels) if levels else np.zeros(0, bool))

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Each key's place; -1 or any place for a key that was not built in."""
        found = np.full(len(keys), -1, np.int64)
        ranks = np.cumsum(self.bits) - 1
        open_keys, start = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = start + (mixed(keys[open_keys], level) % np.uint64(size)).astype(np.int64)
            hit = self.bits[at]
            found[open_keys[hit]] = ranks[at[hit]]
            open_keys, start = open_keys[~hit], start + size
        return found


class Shard(NamedTuple):
    """A perfect hash and the arrays that it indexes."""

    hash: PerfectHash
    prints: np.ndarray
    n_docs: np.ndarray
    last_doc: np.ndarray

    @classmethod
    def build(cls, first, second, n_docs, last_doc) -> Shard:
        hashed = PerfectHash.build(first)
        order = np.argsort(hashed.places(first))
        return cls(hashed, second[order], n_docs[order], last_doc[order])

    def pack(self) -> bytes:
        head = np.array([len(self.hash.sizes), len(self.prints)], np.int64)
        return b"".join(x.tobytes() for x in (
            head, self.hash.sizes, self.prints, self.last_doc, self.n_docs, np.packbits(self.hash.bits)))

    @classmethod
    def unpack(cls, data: bytes) -> Shard:
        levels, keys = np.frombuffer(data, np.int64, 2).tolist()
        at = 16
        sizes = np.frombuffer(data, np.int64, levels, at)
        at += 8 * levels
        prints = np.frombuffer(data, np.uint64, keys, at)
        last = np.frombuffer(data, np.int64, keys, at + 8 * keys)
        n_docs = np.frombuffer(data, np.int32, keys, at + 16 * keys)
        bits = np.unpackbits(np.frombuffer(data, np.uint8, offset=at + 20 * keys), count=int(sizes.sum()))
        return cls(PerfectHash(sizes, bits.astype(bool)), prints, n_docs, last)

    def last_docs(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which lines the shard holds, and the largest document of each of those."""
        place = self.hash.places(first)
        if not len(self.prints):
            return np.zeros(len(first), bool), self.last_doc
        held = (place >= 0) & (self.prints[place] == second)
        return held, self.last_doc[place[held]]


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """_doc, _a, _b: the distinct line hashes of each row of ``docs`` (_doc, text)."""
    def work(batches):
        for batch in batches:
            ids, hashes = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys = {k for line in (text.as_py() or "").split("\n") if (k := line_key(line, min_chars))}
                hashes.extend(keys)
                ids.extend([doc] * len(keys))
            both = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1])], ["_doc", "_a", "_b"])

    return arrow_map(docs, work, "_doc bigint, _a bigint, _b bigint")


def build_shards(frequent: DataFrame, n_shards: int) -> DataFrame:
    """_shard, _probes, _arrays from ``frequent`` (_a, _b, _n, _last)."""
    def build(frame):
        import pandas as pd

        shard = Shard.build(frame._a.to_numpy().view(np.uint64), frame._b.to_numpy().view(np.uint64),
                            frame._n.to_numpy().clip(max=2 ** 31 - 1).astype(np.int32), frame._last.to_numpy())
        return pd.DataFrame({"_shard": frame._shard[:1], "_probes": [frame._n.sum()], "_arrays": [shard.pack()]})

    ship(frequent.sparkSession)
    return frequent.withColumn("_shard", shard_of(n_shards)).groupBy("_shard").applyInPandas(
        build, "_shard bigint, _probes bigint, _arrays binary")


def shard_of(n_shards: int):
    return F.pmod(F.col("_a"), F.lit(n_shards))


def probe(hashes: DataFrame, shards: DataFrame, n_shards: int) -> DataFrame:
    """_doc, _a, _b of the lines that documents lose."""
    def work(batches):
        now, shard = None, None
        for batch in batches:
            group, salt, kind, doc, first, second = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(6))
            edges = np.flatnonzero((np.diff(group) != 0) | (np.diff(salt) != 0) | (kind[1:] == 0) | (kind[:-1] == 0)) + 1
            for start, end in zip([0, *edges], [*edges, len(group)]):
                if start == end:
                    continue
                if kind[start] == 0:
                    now, shard = (group[start], salt[start]), Shard.unpack(batch.column(6)[int(start)].as_py())
                elif now == (group[start], salt[start]):
                    a, b, d = first[start:end], second[start:end], doc[start:end]
                    held, last = shard.last_docs(a.view(np.uint64), b.view(np.uint64))
                    lost = last != d[held]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x[held][lost]) for x in (d, a, b)], ["_doc", "_a", "_b"])

    # At least as many tasks as the session shuffles to, however few shards there are.
    tasks = int(hashes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = shards.select("_shard", F.greatest(
        F.lit(-(-2 * tasks // n_shards)).cast("long"), 1 + F.floor(F.col("_probes") / SHARD_PROBES)).alias("_salts"))
    zero = F.lit(0).cast("bigint")
    arrays = shards.join(salts, "_shard").select(
        "_shard", F.explode(F.sequence(zero, F.col("_salts") - 1)).alias("_salt"), F.lit(0).alias("_kind"),
        zero.alias("_doc"), zero.alias("_a"), zero.alias("_b"), "_arrays")
    asked = hashes.withColumn("_shard", shard_of(n_shards)).join(salts, "_shard").select(
        "_shard", F.pmod(F.xxhash64("_doc"), F.col("_salts")).alias("_salt"), F.lit(1).alias("_kind"),
        "_doc", "_a", "_b", F.lit(None).cast("binary").alias("_arrays"))
    stream = arrays.unionByName(asked).repartition("_shard", "_salt").sortWithinPartitions(
        "_shard", "_salt", "_kind")
    return arrow_map(stream, work, "_doc bigint, _a bigint, _b bigint")


def drop_repeated_lines(
    docs: DataFrame, min_chars: int, min_docs: int, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """doc_id, n_lines, n_dropped and the text that is left, for every row of ``docs``.

    A line whose stripped, lower-cased form has at least ``min_chars`` code points and stands in at
    least ``min_docs`` documents stays only in the document with the largest id.
    """
    run = RunFolder(docs.sparkSession)
    docs = pick(docs, id_column, text_column).toDF("doc_id", "text")
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    hashes = line_hashes(docs.select(own.alias("_doc"), "text"), min_chars)
    once = hashes.groupBy("_a", "_b", "_doc").agg(F.lit(1).alias("_one"))
    frequent = run.write("frequent", once.groupBy("_a", "_b").agg(
        F.count(F.lit(1)).alias("_n"), F.max("_doc").alias("_last")).where(F.col("_n") >= min_docs))
    n_shards = max(1, -(-frequent.count() // SHARD_KEYS))
    shards = run.write("shards", build_shards(frequent, n_shards))
    lost = probe(hashes, shards, n_shards).groupBy("_doc").agg(
        F.collect_set(F.struct("_a", "_b")).alias("_lost"))
    # Only documents that lose lines are on the small side, which is hashed; texts are not sorted.
    joined = docs.withColumn("_doc", own).join(lost.hint("shuffle_hash"), "_doc", "left").select(
        "doc_id", "text", F.transform("_lost", lambda k: k["_a"]).alias("_a"),
        F.transform("_lost", lambda k: k["_b"]).alias("_b"))

    def cut(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                counts, dropped, texts = [], [], []
                for text, first, second in zip(*(part.column(i) for i in (1, 2, 3))):
                    text = text.as_py() or ""
                    lines = text.split("\n")
                    counts.append(len(lines))
                    if first.is_valid:
                        pairs = np.stack([first.values.to_numpy(), second.values.to_numpy()], axis=1)
                        lost = set(map(bytes, pairs))
                        lines = [line for line in lines if line_key(line, min_chars) not in lost]
                        text = "\n".join(lines)
                    dropped.append(counts[-1] - len(lines))
                    texts.append(text)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64()),
                     pa.array(texts, pa.string())], ["doc_id", "n_lines", "n_dropped", "text"])

    return arrow_map(joined, cut, f"doc_id {docs.dtypes[0][1]}, n_lines bigint, n_dropped bigint, text string")
