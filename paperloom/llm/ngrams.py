"""Interpolated modified Kneser-Ney bigram model: counted in Spark, looked up in mapped arrays.

Word pairs are dealt over a grid: row by the first word, column by the second. So the pairs of
even the commonest word spread over a side of the grid, and what a word's statistics need from
others is at most one partial sum for each shard of its row or column. Tasks count the distinct
pairs of a group of texts first; a shard merges those counts and writes its sorted hashes and
counts as plain arrays to the shared folder. For scoring, workers map one shard's arrays after
the other into memory and look up the sorted distinct pairs of a group of texts.
"""

from __future__ import annotations

import contextlib
import math
import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import column, fresh_path, give_back, ship, text_groups
from paperloom.llm.words import ASCII_LOWER, mix, texts_to_words

SHARD_BYTES = 12 * 1024 * 1024  # training text per shard of the grid
GROUP_BYTES = 12 * 1024 * 1024

# Hashes of the text's two ends; words never have them but by a 64-bit coincidence.
BEGIN, END = np.uint64(0x626567696E), np.uint64(0x656E64)
_STEP = np.uint64(0x9E3779B97F4A7C15)

_ROW = pa.schema([("shard", pa.int32()), ("payload", pa.binary())])
_ROW_DDL = "shard int, payload binary"


def _pack(**columns: np.ndarray) -> bytes:
    """Arrays as one message; small integers are compressed, hashes would not get smaller."""
    arrays = [pa.array(v) for v in columns.values()]
    batch = pa.RecordBatch.from_arrays(arrays, list(columns))
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(payload: bytes) -> dict[str, np.ndarray]:
    table = pa.ipc.open_stream(payload).read_all()
    return {n: table.column(n).combine_chunks().to_numpy(False) for n in table.column_names}


def _rows(shards: list[int], payloads: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(shards, pa.int32()), pa.array(payloads, pa.binary())], schema=_ROW
    )


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts one behind the other: contexts, tokens (the end included), and text ends."""
    words, ends = texts_to_words(texts, ASCII_LOWER)
    n = len(words) + len(texts)
    stops = ends[1:] + np.arange(len(texts))  # places of the end tokens
    second = np.empty(n, np.uint64)
    is_end = np.zeros(n, bool)
    is_end[stops] = True
    second[is_end] = END
    second[~is_end] = words
    first = np.empty(n, np.uint64)
    first[1:] = second[:-1]
    first[:1] = BEGIN
    first[1:][is_end[:-1]] = BEGIN
    return first, second, np.concatenate([[0], stops + 1])


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * _STEP + second)


def _side(hashes: np.ndarray, side: int) -> np.ndarray:
    return (hashes % np.uint64(side)).astype(np.int64)


def shard_of(first: np.ndarray, second: np.ndarray, side: int) -> np.ndarray:
    return _side(first, side) * side + _side(second, side)


def _count_pairs(side: int):
    """Distinct pairs of groups of texts with their counts, by shard."""

    def run(batches):
        for _, texts in text_groups(batches, GROUP_BYTES):
            first, second, _ = tokens(texts)
            _, at, counts = np.unique(
                pair_keys(first, second), return_index=True, return_counts=True
            )
            first, second = first[at], second[at]
            shards = shard_of(first, second, side)
            order = np.lexsort((first, shards))
            first, second, counts = first[order], second[order], counts[order].astype(np.uint32)
            ends = np.searchsorted(shards[order], np.arange(side * side + 1))
            for shard in range(side * side):
                a, b = ends[shard], ends[shard + 1]
                if a == b:
                    continue
                heads = np.flatnonzero(np.r_[True, first[a + 1 : b] != first[a : b - 1]])
                run_lengths = np.diff(np.r_[heads, b - a]).astype(np.uint32)
                contexts = first[a:b][heads]
                head = _pack(first=contexts, run=run_lengths)
                tail = _pack(second=second[a:b], count=counts[a:b])
                yield _rows([shard], [len(head).to_bytes(8, "big") + head + tail])

    return run


def _sum_by(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys and the sums of the values by key."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    sums = [np.add.reduceat(v[order].astype(np.int64), heads) if len(heads) else v for v in values]
    return (keys[heads], *sums)


class _Store:
    """Plain arrays in a folder of any file system; written whole or not at all."""

    def __init__(self, folder: str):
        from pyarrow import fs

        scheme, _, rest = folder.partition(":")
        self.local = not rest or scheme == "file"
        if self.local:
            self.system, self.path = fs.LocalFileSystem(), "/" + (rest or folder).lstrip("/")
        else:
            names = {"s3a": "s3", "s3n": "s3"}
            self.system, self.path = fs.FileSystem.from_uri(f"{names.get(scheme, scheme)}:{rest}")

    def write(self, name: str, array: np.ndarray) -> None:
        self.system.create_dir(self.path, recursive=True)
        target = f"{self.path}/{name}"
        part = f"{target}.{uuid.uuid4().hex}" if self.local else target
        with self.system.open_output_stream(part) as out:
            out.write(np.ascontiguousarray(array).view(np.uint8).data)
        if part != target:  # a repeated task replaces the file with the same content
            self.system.move(part, target)

    @contextlib.contextmanager
    def mapped(self, name: str, dtype) -> Iterator[np.ndarray]:
        """The array, mapped into memory; from far storage by way of a passing local file."""
        source, copy = f"{self.path}/{name}", None
        if not self.local:
            handle, copy = tempfile.mkstemp()
            with os.fdopen(handle, "wb") as out, self.system.open_input_stream(source) as data:
                while block := data.read(1 << 20):
                    out.write(block)
            source = copy
        try:
            empty = os.path.getsize(source) == 0
            yield np.zeros(0, dtype) if empty else np.memmap(source, dtype, "r")
        finally:
            if copy:
                os.unlink(copy)


_STATS = "n1 long, n2 long, n3 long, n4 long, total long, entries long"


def _merge_shard(folder: str, side: int):
    """Merge a shard's pair counts and write them; send partial sums on for both words.

    Shards of the next step: words of contexts under 2 w, words that follow under 2 w + 1, where
    w is the word's place on its side of the grid; statistics of pairs under -1.
    """

    def run(group: pa.Table) -> pa.Table:
        give_back()
        shard = group.column("shard")[0].as_py()
        parts = []
        for payload in group.column("payload").to_pylist():
            border = 8 + int.from_bytes(payload[:8], "big")
            runs, pairs = _unpack(payload[8:border]), _unpack(payload[border:])
            parts.append((np.repeat(runs["first"], runs["run"]), pairs["second"], pairs["count"]))
        first, second, count = (np.concatenate(p) for p in zip(*parts, strict=True))
        count = count.astype(np.int64)
        keys = pair_keys(first, second)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        count = np.add.reduceat(count[order], heads)
        keys, first, second = keys[heads], first[order][heads], second[order][heads]
        store = _Store(folder)
        store.write(f"pairs-{shard}", keys)
        store.write(f"counts-{shard}", count.astype(np.uint32))
        contexts = _sum_by(first, count, count == 1, count == 2, count > 2)
        words = _sum_by(second, count, np.ones(len(count), np.int64))
        many = np.bincount(np.minimum(count, 5), minlength=6)[1:5]
        stats = np.array([*many, count.sum(), len(count)], np.int64)
        names = ("key", "c", "n1", "n2", "n3")
        return pa.Table.from_batches(
            [
                _rows(
                    [2 * (shard // side), 2 * (shard % side) + 1, -1],
                    [
                        _pack(**dict(zip(names, contexts, strict=True))),
                        _pack(**dict(zip(("key", "c", "n"), words, strict=True))),
                        _pack(stats=stats),
                    ],
                )
            ]
        )

    return run


def _merge_words(folder: str):
    """Write the contexts or the words of one place of the grid's side; return statistics."""

    def run(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        parts = [_unpack(p) for p in group.column("payload").to_pylist()]
        if shard < 0:
            sums = np.sum([p["stats"] for p in parts], axis=0)
            return pa.table([pa.array([-1], pa.int32()), *([int(x)] for x in sums)], _STAT_NAMES)
        names = list(parts[0])
        joined = [np.concatenate([p[n] for p in parts]) for n in names]
        keys, *sums = _sum_by(*joined)
        store, place = _Store(folder), shard // 2
        kind = "word" if shard % 2 else "context"
        store.write(f"{kind}-{place}", keys)
        store.write(f"{kind}-values-{place}", np.column_stack(sums).astype(np.int64))
        row = [0] * 6
        if kind == "word":
            many = np.bincount(np.minimum(sums[1], 5), minlength=6)[1:5]
            row = [*map(int, many), int(sums[0].sum()), len(keys)]
        return pa.table([pa.array([int(kind == "word")], pa.int32()), *([x] for x in row)], _STAT_NAMES)

    return run


_STAT_NAMES = ["kind", "n1", "n2", "n3", "n4", "total", "entries"]


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Discounts of counts of one, two and more (Chen and Goodman 1998).

    Where a count of counts is zero, the formula has no value; then half a count is taken off,
    which keeps the model proper on small texts.
    """
    if not (n1 and n2 and n3 and n4):
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.05), k - 0.05) for d, k in zip(found, (1, 2, 3), strict=True))


def train(texts: DataFrame) -> dict:
    """Count the texts (one column) and write the model; returns its folder and constants.

    Null texts count as empty ones: a lone end token. Without texts the model knows no word.
    """
    spark = texts.sparkSession
    ship(spark)
    name = texts.columns[0]
    size = texts.agg(F.sum(F.octet_length(column(name)))).first()[0] or 0
    side = max(2, math.ceil(math.sqrt(size / SHARD_BYTES)))
    folder = fresh_path(spark, "ngrams")
    pairs = texts.select(column(name).alias("text")).mapInArrow(_count_pairs(side), _ROW_DDL)
    merged = pairs.groupBy("shard").applyInArrow(_merge_shard(folder, side), _ROW_DDL)
    stats = merged.groupBy("shard").applyInArrow(_merge_words(folder), "kind int, " + _STATS)
    sums = stats.groupBy("kind").agg(*[F.sum(n).alias(n) for n in _STAT_NAMES[1:]]).collect()
    found = {r.kind: tuple(r)[1:] for r in sums}
    pair_stats, word_stats = found.get(-1, (0,) * 6), found.get(1, (0,) * 6)
    return {
        "folder": folder,
        "side": side,
        "pair_discounts": discounts(*pair_stats[:4]),
        "pairs": pair_stats[5],
        "word_discounts": discounts(*word_stats[:4]),
        # Words by the number of words in front of them: one, two, more.
        "word_counts": (*word_stats[:2], word_stats[5] - word_stats[0] - word_stats[1]),
        "tokens": word_stats[4],
        "words": word_stats[5],
    }


def _find(store: _Store, kind: str, values: str, place: int, wanted: np.ndarray, width: int):
    """Values of the wanted keys, in their order; zeros for those that are not there."""
    dtype = np.uint32 if kind == "pairs" else np.int64
    with (
        store.mapped(f"{kind}-{place}", np.uint64) as keys,
        store.mapped(f"{values}-{place}", dtype) as data,
    ):
        out = np.zeros((len(wanted), width), np.int64)
        if len(keys):
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            there = keys[at] == wanted
            out[there] = data.reshape(-1, width)[at[there]]
        return out


def _lookup(store: _Store, kind: str, values: str, keys, places, n_places: int, width: int):
    """Look up distinct keys place by place; keys of one place in sorted order."""
    out = np.zeros((len(keys), width), np.int64)
    order = np.lexsort((keys, places))
    ends = np.searchsorted(places[order], np.arange(n_places + 1))
    for place in range(n_places):
        part = order[ends[place] : ends[place + 1]]
        if len(part):
            out[part] = _find(store, kind, values, place, keys[part], width)
    return out


class Scorer:
    """log10 probabilities of groups of texts."""

    def __init__(self, model: dict):
        self.model, self.store = model, _Store(model["folder"])

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """For each text: tokens, known tokens, unigram score, model score."""
        m = self.model
        first, second, ends = tokens(texts)
        starts = ends[:-1]
        if not m["tokens"]:
            zeros = np.zeros(len(starts))
            base = np.diff(ends) * math.log10(0.1 / 0.1)
            return np.diff(ends), zeros.astype(np.int64), base, zeros
        side = m["side"]
        words, word_at = np.unique(second, return_inverse=True)
        known = _lookup(
            self.store, "word", "word-values", words, _side(words, side), side, 2
        )
        contexts, context_at = np.unique(first, return_inverse=True)
        before = _lookup(
            self.store, "context", "context-values", contexts, _side(contexts, side), side, 4
        )
        _, at, pair_at = np.unique(
            pair_keys(first, second), return_index=True, return_inverse=True
        )
        keys, shards = pair_keys(first[at], second[at]), shard_of(first[at], second[at], side)
        count = _lookup(self.store, "pairs", "counts", keys, shards, side * side, 1)[:, 0]

        base = np.log10((known[:, 0] + 0.1) / (m["tokens"] + 0.1 * (m["words"] + 1)))
        d1, d2, d3 = m["word_discounts"]
        n1, n2, n3 = m["word_counts"]
        after = known[:, 1]  # distinct words in front of this one
        taken = np.select([after == 0, after == 1, after == 2], [0.0, d1, d2], d3)
        rest = (d1 * n1 + d2 * n2 + d3 * n3) / m["pairs"]
        lower = (after - taken) / m["pairs"] + rest / (m["words"] + 1)
        d1, d2, d3 = m["pair_discounts"]
        total = np.maximum(before[:, 0], 1)
        seen = before[:, 0] > 0
        gamma = np.where(seen, (before[:, 1:] @ np.array([d1, d2, d3])) / total, 1.0)
        taken = np.select([count == 0, count == 1, count == 2], [0.0, d1, d2], d3)
        c = context_at[at]
        direct = np.where(seen[c], (count - taken) / total[c], 0.0)
        pair = np.log10(direct + gamma[c] * lower[word_at[at]])
        return (
            np.diff(ends),
            np.add.reduceat((known[:, 0] > 0)[word_at].astype(np.int64), starts),
            np.add.reduceat(base[word_at], starts),
            np.add.reduceat(pair[pair_at], starts),
        )


def score(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every row of `docs`.

    Scores are sums of log10 probabilities; perplexity is 10 ** (-score / n_tokens). A null text
    counts as empty: one token, the end. Null ids and repeated rows are kept; other columns are
    not looked at.
    """
    ship(docs.sparkSession)

    def run(batches):
        scorer = Scorer(model)
        for columns, texts in text_groups(batches, GROUP_BYTES):
            n, known, base, found = scorer.score(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array(known, pa.int64()),
                    pa.array(base, pa.float64()),
                    pa.array(found, pa.float64()),
                ],
                ["doc_id", "n_tokens", "n_known", "base_score", "score"],
            )

    rows = docs.select(column("doc_id").cast("long").alias("doc_id"), column(text).alias("text"))
    return rows.mapInArrow(
        run, "doc_id long, n_tokens long, n_known long, base_score double, score double"
    )


def held_out_scores(docs: DataFrame, folds: int = 10) -> DataFrame:
    """Scores of all documents by a model of those outside the held-out fold.

    held_out: crc32 of doc_id as text is divisible by `folds`; null, and not learned from, for a
    null doc_id.
    """
    held_out = F.crc32(F.col("doc_id").cast("string")) % folds == 0
    model = train(docs.filter(~held_out).select("text"))
    return (
        score(docs, model)
        .withColumn("held_out", held_out)
        .withColumn("train_tokens", F.lit(model["tokens"]).cast("long"))
    )
