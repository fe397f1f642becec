"""Passages that repeat: fixed-block anchors, probed by every rolling window, then extended.

With blocks of half a window (rounded up), every window holds a whole block, whichever way its
text is cut into blocks from its beginning. So a passage of a window's length that stands twice
gives a hit at both places: a block there, and an equal run of words here.

1. Chunks of texts send the hashes of all runs of a block's length, marking those that are
   blocks, to the shard of each hash. A run that occurs twice, at least once as a block, is an
   anchor; the shard names it to the chunks that have it.
2. Around its anchors a chunk extends to all windows that hold one, and sends their hashes. A
   shard tells which of them occur twice; together they are the maximal exact repeats.
3. The chunk removes what those windows cover.

A chunk sends each distinct hash once, so a passage in a third of all documents is one entry for
each chunk. Texts move compressed, twice, to meet the answers under the chunk's name; chunks and
shards are bounded and grow in number with the corpus.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import column, give_back, ship, text_groups, written
from paperloom.llm.words import BASES, inside, run_hashes, word_arrays

WINDOW = 35  # words
CHUNK_BYTES = 24 * 1024 * 1024
SHARD_BYTES = 16 * 1024 * 1024

_MESSAGE = "chunk binary, shard int, payload binary"
_SCHEMA = pa.schema([("chunk", pa.binary()), ("shard", pa.int32()), ("payload", pa.binary())])


def _message(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA
    )


def _pack(compression: str | None = None, **columns) -> bytes:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()]
    batch = pa.RecordBatch.from_arrays(arrays, list(columns))
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=compression)
    with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def _array(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(False)


def _chunks(batches):
    """Chunks of rows, named by their content, so that a recomputed task names them alike."""
    for columns, texts in text_groups(batches, CHUNK_BYTES):
        name = hashlib.blake2b(digest_size=16)
        for key, text in zip(columns[0], texts, strict=True):
            name.update(f"{key},{len(text)};".encode())
            name.update(text)
        yield name.digest(), columns[0], texts


def _send_texts(batches):
    """Each chunk's keys and texts, under shard -1."""
    for name, keys, texts in _chunks(batches):
        payload = _pack("zstd", key=pa.array(keys, pa.int64()), text=pa.array(texts, pa.binary()))
        yield _message([(name, -1, payload)])


def _send_hashes(name: bytes, shards: np.ndarray, keys: np.ndarray, many, block, n_shards: int):
    """Distinct keys by shard, with marks: several times in this chunk; a block."""
    order = np.argsort(shards, kind="stable")
    ends = np.searchsorted(shards[order], np.arange(n_shards + 1))
    for shard in range(n_shards):
        part = order[ends[shard] : ends[shard + 1]]
        if len(part):
            marks = many[part].astype(np.uint8) | (block[part].astype(np.uint8) << 1)
            yield _message([(name, shard, _pack(key=keys[part], marks=marks))])


def _runs(words: np.ndarray, ends: np.ndarray, size: int):
    """Hashes of all runs of `size` words, and which of the places have one."""
    hashed = run_hashes(words, size)
    return hashed, inside(ends, size, len(hashed))


def _anchor_key(hashed: np.ndarray, n_shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard and key of a run: a chance collision costs a look at a window, never a result."""
    shards = (hashed % np.uint64(n_shards)).astype(np.int32)
    return shards, (hashed >> np.uint64(32)).astype(np.uint32)


def _probe(block: int, n_shards: int):
    """Every run of a block's length, as probe, and as block where it is one."""

    def run(batches):
        for name, _, texts in _chunks(batches):
            words, ends = word_arrays(texts)
            hashed, real = _runs(words, ends, block)
            begins = np.repeat(ends[:-1], np.diff(ends))[: len(hashed)]
            aligned = (np.arange(len(hashed)) - begins) % block == 0
            hashed, aligned = hashed[real], aligned[real]
            order = np.argsort(hashed, kind="stable")
            hashed, aligned = hashed[order], aligned[order]
            heads = np.flatnonzero(np.r_[True, hashed[1:] != hashed[:-1]][: len(hashed)])
            if not len(heads):
                continue
            many = np.diff(np.r_[heads, len(hashed)]) > 1
            is_block = np.logical_or.reduceat(aligned, heads)
            shards, keys = _anchor_key(hashed[heads], n_shards)
            yield from _send_hashes(name, shards, keys, many, is_block, n_shards)

    return run


def _twice(group: pa.Table) -> pa.Table:
    """Of the keys that chunks sent: those found twice, at least once as a block."""
    chunks, shards, payloads = (c.to_pylist() for c in group.columns)
    sent = [_unpack(p) for p in payloads]
    keys = [_array(t, "key") for t in sent]
    joined, marks = np.concatenate(keys), np.concatenate([_array(t, "marks") for t in sent])
    order = np.argsort(joined, kind="stable")
    joined, marks = joined[order], marks[order]
    heads = np.flatnonzero(np.r_[True, joined[1:] != joined[:-1]])
    several = (np.diff(np.r_[heads, len(joined)]) > 1) | (
        np.bitwise_or.reduceat(marks & 1, heads) > 0
    )
    hit = joined[heads[several & (np.bitwise_or.reduceat(marks & 2, heads) > 0)]]
    rows = []
    for chunk, shard, own in zip(chunks, shards, keys, strict=True):
        found = own[np.isin(own, hit)]
        if len(found):
            rows.append((chunk, shard, _pack(key=found)))
    return pa.Table.from_batches([_message(rows)] if rows else [], _SCHEMA)


def _known(group: pa.Table) -> tuple[list[pa.Table], np.ndarray, np.ndarray]:
    """Of a chunk: its texts; shards and keys of the answers."""
    texts, shards, keys = [], [np.zeros(0, np.int32)], []
    for shard, payload in zip(
        group.column("shard").to_pylist(), group.column("payload").to_pylist(), strict=True
    ):
        if shard < 0:
            texts.append(_unpack(payload))
        else:
            keys.append(_array(_unpack(payload), "key"))
            shards.append(np.full(len(keys[-1]), shard, np.int32))
    return texts, np.concatenate(shards), np.concatenate(keys or [np.zeros(0, np.uint64)])


def _candidates(words, ends, window: int, block: int, n_shards: int, shards, keys):
    """Places of windows that hold an anchor, with their hashes and shards."""
    hashed, real = _runs(words, ends, block)
    at_shard, at_key = _anchor_key(hashed, n_shards)
    anchors = np.sort((shards.astype(np.uint64) << np.uint64(32)) | keys.astype(np.uint64))
    own = (at_shard.astype(np.uint64) << np.uint64(32)) | at_key
    if len(anchors):
        near = np.minimum(np.searchsorted(anchors, own), len(anchors) - 1)
        hit = real & (anchors[near] == own)
    else:
        hit = np.zeros(len(own), bool)
    before = np.concatenate([[0], np.cumsum(hit)])
    n = max(0, len(words) - window + 1)
    around = window - block + 1  # places of a block within a window
    holds = before[np.arange(n) + around] > before[np.arange(n)]
    places = np.flatnonzero(inside(ends, window, n) & holds)
    del hashed, own, hit, before
    found = run_hashes(words, window)[places]
    second = run_hashes(words, window, BASES[1])[places]
    return places, found, (second % np.uint64(n_shards)).astype(np.int32)


def _extend(window: int, block: int, n_shards: int):
    """All windows around a chunk's anchors, distinct ones once."""

    def run(group: pa.Table) -> pa.Table:
        give_back()
        tables, shards, keys = _known(group)
        name, rows = group.column("chunk")[0].as_py(), []
        for table in tables if len(keys) else []:
            words, ends = word_arrays(table.column("text").to_pylist())
            _, found, at = _candidates(words, ends, window, block, n_shards, shards, keys)
            if not len(found):
                continue
            order = np.lexsort((found, at))
            found, at = found[order], at[order]
            new = np.r_[True, (found[1:] != found[:-1]) | (at[1:] != at[:-1])]
            heads = np.flatnonzero(new)
            many = np.diff(np.r_[heads, len(found)]) > 1
            yes = np.ones(len(heads), bool)
            rows.extend(_send_hashes(name, at[heads], found[heads], many, yes, n_shards))
        return pa.Table.from_batches(rows, _SCHEMA)

    return run


_TEXTS = "doc_id long, n_words long, n_removed long, text string"
_DIGESTS = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _remove(window: int, block: int, n_shards: int, digest: bool):
    """Texts without the words that repeated windows cover."""

    def run(group: pa.Table) -> pa.Table:
        give_back()
        anchors = group.filter(pc.equal(group.column("step"), 1))
        repeated = group.filter(pc.equal(group.column("step"), 2))
        texts = group.filter(pc.equal(group.column("step"), 0))
        _, shards, keys = _known(anchors)
        _, twice_shards, twice = _known(repeated)
        order = np.lexsort((twice_shards, twice))
        twice, twice_shards = twice[order], twice_shards[order]
        ids, n_words, n_removed, kept = [], [], [], []
        for table in _known(texts)[0]:
            values = table.column("text").to_pylist()
            ids.extend(table.column("key").to_pylist())
            words, ends = word_arrays(values)
            covered = np.zeros(len(words) + 1, np.int32)
            if len(twice):
                places, found, at = _candidates(
                    words, ends, window, block, n_shards, shards, keys
                )
                near = np.minimum(np.searchsorted(twice, found), len(twice) - 1)
                # Equal hashes of two shards stand side by side.
                same = (twice[near] == found) & (twice_shards[near] == at)
                if (twice[1:] == twice[:-1]).any():
                    after = np.minimum(near + 1, len(twice) - 1)
                    same |= (twice[after] == found) & (twice_shards[after] == at)
                places = places[same]
                np.add.at(covered, places, 1)
                np.add.at(covered, places + window, -1)
            keep = np.cumsum(covered[:-1]) == 0
            for text, a, b in zip(values, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                own = text.split()
                mask = keep[a:b]
                n = int(mask.sum())
                rest = b" ".join(own if n == b - a else compress(own, mask.tolist()))
                n_words.append(b - a)
                n_removed.append(b - a - n)
                kept.append(hashlib.sha256(rest).hexdigest() if digest else rest.decode())
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "kept_sha256" if digest else "text": pa.array(kept, pa.string()),
            }
        )

    return run


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    digest: bool = False,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Texts without passages of `window` or more words that also stand elsewhere.

    Words are runs of characters that are no ASCII white space. A word goes if a run of `window`
    consecutive words of its text covers it, and the same run begins anywhere else, in another
    text or in this one; all runs are judged on the input. Returns one row per row of `docs`:
    doc_id, n_words, n_removed and text, the words kept, joined by one space (with `digest`
    instead kept_sha256, of its UTF-8). A null text has no words and becomes an empty one;
    repeated rows repeat each other. Null keys are kept; other columns are not looked at; an
    empty table gives an empty result. `docs` should be a table scan: it is read three times,
    and must show the same rows in the same order within a split each time.
    """
    spark = docs.sparkSession
    ship(spark)
    block = (window + 1) // 2
    rows = docs.select(column(key).cast("long").alias("doc_id"), column(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_shards = max(8, -(-size // SHARD_BYTES))
    texts = rows.mapInArrow(_send_texts, _MESSAGE)
    anchors = (
        rows.mapInArrow(_probe(block, n_shards), _MESSAGE)
        .groupBy("shard")
        .applyInArrow(_twice, _MESSAGE)
    )
    anchors = written(anchors, "anchors")
    repeated = (
        anchors.unionByName(texts)
        .groupBy("chunk")
        .applyInArrow(_extend(window, block, n_shards), _MESSAGE)
        .groupBy("shard")
        .applyInArrow(_twice, _MESSAGE)
    )
    parts = [
        frame.withColumn("step", F.lit(step)) for step, frame in enumerate((texts, anchors, repeated))
    ]
    return (
        parts[0]
        .unionByName(parts[1])
        .unionByName(parts[2])
        .groupBy("chunk")
        .applyInArrow(_remove(window, block, n_shards, digest), _DIGESTS if digest else _TEXTS)
    )
