"""Byte-level BPE: each distinct pre-token of the corpus is encoded once.

Spark splits the texts into pre-tokens. An Arrow batch of rows is a chunk: its tokens become
positions in the chunk's own list of distinct words. The words go to buckets of the global
vocabulary (one entry per chunk and word, however often the word occurs); a bucket encodes each
of its words once and answers the chunks that asked. A chunk's positions and answers meet under
the chunk's name, where ids are put in place of words. Buckets and chunks are bounded, and their
number grows with the corpus; only the vocabulary file is known everywhere.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import give_back, ship

SLICE_ROWS = 500  # rows put together at a time
BUCKET_BYTES = 8 * 1024 * 1024  # text of the corpus per vocabulary bucket

_MESSAGE = "chunk binary, bucket int, payload binary"
_SCHEMA = pa.schema([("chunk", pa.binary()), ("bucket", pa.int32()), ("payload", pa.binary())])


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding(
        "corpus", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={}
    )


@lru_cache(maxsize=2)
def _token_tables(path: str) -> tuple[pa.Array, pa.Array]:
    """For each id: its bytes, and its decimal digits."""
    by_id = {rank: token for token, rank in read_ranks(path).items()}
    ids = range(max(by_id, default=-1) + 1)
    return pa.array([by_id.get(i) for i in ids], pa.binary()), pa.array(
        [str(i).encode() for i in ids], pa.binary()
    )


def _pack(**columns: pa.Array) -> bytes:
    batch = pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def _message(*row) -> pa.RecordBatch:
    columns = [pa.array([v], f.type) for v, f in zip(row, _SCHEMA, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)


def _chunks(batches):
    """Of each batch: a name made of its content, keys, row ends, positions and distinct words.

    As the name follows from the content, a recomputed task names its chunks alike.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        words = batch.column(1)
        ends = np.cumsum(pc.fill_null(pc.list_value_length(words), 0).to_numpy(False))
        coded = pc.dictionary_encode(words.flatten())
        keys, positions = batch.column(0), coded.indices
        name = hashlib.blake2b(digest_size=16)
        name.update(repr(keys.to_pylist()).encode())
        for part in (ends, positions.to_numpy(False)):
            name.update(np.ascontiguousarray(part, np.int64))
        for text in coded.dictionary.to_pylist():
            name.update(text.encode() + b"\xff")
        yield name.digest(), keys, ends, positions, coded.dictionary


def _ask(n_buckets: int):
    """Each chunk's distinct words with their places in its list, by bucket."""

    def run(batches):
        for name, _, _, _, words in _chunks(batches):
            hashes = np.fromiter(
                map(xxhash.xxh3_64_intdigest, words.to_pylist()), np.uint64, len(words)
            )
            buckets = (hashes % np.uint64(n_buckets)).astype(np.int32)
            order = np.argsort(buckets, kind="stable").astype(np.int32)
            starts = np.searchsorted(buckets[order], np.arange(n_buckets + 1))
            for bucket in np.unique(buckets):
                places = pa.array(order[starts[bucket] : starts[bucket + 1]])
                yield _message(name, int(bucket), _pack(place=places, word=words.take(places)))
            give_back()

    return run


def _send_positions(batches):
    """Each chunk's keys and positions, under bucket -1."""
    for name, keys, ends, positions, _ in _chunks(batches):
        starts = np.concatenate([[0], ends]).astype(np.int32)
        rows = pa.ListArray.from_arrays(pa.array(starts), positions)
        yield _message(name, -1, _pack(key=keys, positions=rows))
        give_back()


def _encode_bucket(path: str, pattern: str):
    """Encode each distinct word of the bucket once; answer every chunk that asked.

    Chunks of equal content share their name and ask for the same: they get one answer.
    """

    def run(group: pa.Table) -> pa.Table:
        encode = _encoder(path, pattern).encode_ordinary
        ids: dict[str, list[int]] = {}
        answers, answered = [], set()
        for chunk, bucket, payload in zip(*(c.to_pylist() for c in group.columns), strict=True):
            if chunk in answered:
                continue
            answered.add(chunk)
            asked = _unpack(payload)
            words = asked.column("word").to_pylist()
            for word in words:
                if word not in ids:
                    ids[word] = encode(word)
            found = pa.array([ids[w] for w in words], pa.list_(pa.int32()))
            place = asked.column("place").combine_chunks()
            answers.append(_message(chunk, bucket, _pack(place=place, ids=found)))
        return pa.Table.from_batches(answers, _SCHEMA)

    return run


_IDS = "doc_id long, ids array<int>, decoded binary"
_DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _lists(values: pa.Array, starts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), values)


def _sha256(texts: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(t).hexdigest() for t in texts.to_pylist()], pa.string())


def _reassemble(path: str, digest: bool):
    """Put the ids in place of the words, and decode them through the token-byte table."""

    def run(group: pa.Table) -> pa.Table:
        token_bytes, digits = _token_tables(path)
        answers, chunks = [], []
        for bucket, payload in zip(
            group.column("bucket").to_pylist(), group.column("payload").to_pylist(), strict=True
        ):
            (chunks if bucket < 0 else answers).append(_unpack(payload))
        if answers:
            found = pa.concat_tables(answers).sort_by("place").combine_chunks()
            if not np.array_equal(found.column("place").to_numpy(), np.arange(len(found))):
                raise ValueError("a chunk's answers are not one for each of its words")
            known = found.column("ids").combine_chunks()
        else:
            known = pa.array([], pa.list_(pa.int32()))
        # Each of the chunks of equal content gives its rows.
        slices = (
            chunk.slice(at, SLICE_ROWS)
            for chunk in chunks
            for at in range(0, chunk.num_rows, SLICE_ROWS)
        )
        tables = []
        for chunk in slices:
            rows = chunk.column("positions").combine_chunks()
            ids = known.take(rows.flatten())
            token_ends = np.concatenate([[0], np.cumsum(pc.list_value_length(ids).to_numpy(False))])
            offsets = rows.offsets.to_numpy()
            starts = token_ends[offsets - offsets[0]]
            flat = ids.flatten()
            decoded = pc.binary_join(_lists(token_bytes.take(flat), starts), b"")
            columns = {"doc_id": chunk.column("key").combine_chunks()}
            if digest:
                as_text = pc.binary_join(_lists(digits.take(flat), starts), b",")
                columns["n_tokens"] = pa.array(np.diff(starts), pa.int64())
                columns["ids_sha256"] = _sha256(as_text)
                columns["decoded_sha256"] = _sha256(decoded)
            else:
                columns["ids"] = _lists(flat, starts)
                columns["decoded"] = decoded
            tables.append(pa.table(columns))
        give_back()
        return pa.concat_tables(tables)

    return run


def encode_decode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    digest: bool = False,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Token ids of every text, and the bytes they decode to.

    Returns one row per row of `docs`: doc_id, ids, decoded; with `digest` instead doc_id,
    n_tokens, ids_sha256 (of the decimal ids joined by commas) and decoded_sha256.

    A null text counts as empty: no ids, empty bytes. A null key stays null; repeated rows are
    kept. An empty table gives an empty result. Other columns are ignored, whatever their
    names. `docs` should be a table scan: it is read twice, and both readings must see the
    same rows in the same order within a split (else a task fails for a missing word).
    """
    ship(docs.sparkSession)
    total = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    n_buckets = max(8, -(-total // BUCKET_BYTES))
    # White space is what Unicode says, as in the pattern's own library.
    words = F.regexp_extract_all(F.col(text), F.lit("(?U)" + pattern), F.lit(0))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), words.alias("words"))
    asked = rows.mapInArrow(_ask(n_buckets), _MESSAGE)
    answers = asked.groupBy("bucket").applyInArrow(_encode_bucket(ranks_path, pattern), _MESSAGE)
    return (
        answers.unionByName(rows.mapInArrow(_send_positions, _MESSAGE))
        .groupBy("chunk")
        .applyInArrow(_reassemble(ranks_path, digest), _DIGESTS if digest else _IDS)
    )
