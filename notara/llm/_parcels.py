"""Distributed look-up of very many 64-bit keys in compact form.

A scan cuts its texts into parcels (about 1 MB of whole texts).  A parcel has one body row
(shard -1) and, for each shard, one row with its sorted distinct keys of that shard.  A key's shard
is its leading bits, so keys are spread evenly whatever their frequency, and a key that is very
frequent costs a parcel eight bytes at most.  A shard answers its keys in order, and the answers go
back to the parcel's body.  Nothing is collected by key and no task sees more than a shard or a parcel.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import lean, save

SCHEMA = "parcel string, shard int, body binary"
KEYS_PER_SHARD = 400_000
_U = np.uint64


def shard_bits(keys: int) -> int:
    """Leading bits that give shards of about KEYS_PER_SHARD keys; 8 shards at least."""
    return max(3, int(np.ceil(np.log2(max(1, keys) / KEYS_PER_SHARD))))


def rows(body: dict, keys: np.ndarray, bits: int, more: tuple[np.ndarray, list[np.ndarray]] | None = None) -> pa.RecordBatch:
    """A parcel's rows; keys are sorted and distinct.  more: split() of keys of another kind, whose shards stand from 1 << bits on."""
    name = uuid.uuid4().hex
    own, parts = split(keys, (keys >> _U(64 - bits)).astype(np.int64))
    shards = [-1, *own.tolist()]
    if more:
        shards += (more[0] + (1 << bits)).tolist()
        parts = [*parts, *more[1]]
    return pa.RecordBatch.from_arrays([pa.array([name] * len(shards)), pa.array(shards, pa.int32()), pa.array([pickle.dumps(body, 5), *(p.tobytes() for p in parts)], pa.binary())], names=["parcel", "shard", "body"])


def split(keys: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Shards (sorted) that the keys have, and the keys of each: a parcel costs its keys, however many shards there are."""
    first = np.flatnonzero(np.diff(shard, prepend=-1))
    return shard[first], np.split(keys, first[1:]) if len(first) else []


def _no_annotations(f: Callable) -> Callable:
    """applyInArrow looks at annotations, which are strings here."""
    f.__annotations__ = {}
    return f


def answer(sent: DataFrame, table: DataFrame | None, reply: Callable, finish: Callable[[dict, np.ndarray], pa.Table], kind: np.dtype, schema: str, other: tuple[int, Callable] | None = None) -> DataFrame:
    """Answers of the shards, brought back to the parcels.

    sent: a saved table of rows().  table: rows (shard, key, n) that the shards look up, or None.
    reply(keys: list of arrays, table) gives an array of `kind` for each of the key arrays;
    finish(body, answers of all its keys in order) gives the parcel's part of the result.
    other: the first shard of the other kind of keys, and the reply to those.
    """
    kind = np.dtype(kind)

    def respond(parcels, known=None):
        keys = [np.frombuffer(x.as_py(), _U) for x in parcels.column("body")]
        own = other[1] if other and len(keys) and parcels.column("shard")[0].as_py() >= other[0] else reply
        out = own(keys, known) if len(keys) else []
        return pa.table({"parcel": parcels.column("parcel"), "shard": parcels.column("shard"), "body": pa.array([x.astype(kind).tobytes() for x in out], pa.binary())})

    def respond_alone(parcels):
        return respond(parcels)

    def close(group):
        shard = group.column("shard").to_numpy()
        order = np.argsort(shard, kind="stable")
        bodies = group.column("body")
        body = pickle.loads(bodies[int(order[0])].as_py())
        got = np.frombuffer(b"".join(bodies[int(i)].as_py() for i in order[1:]), kind)
        return finish(body, got)

    asked = sent.where("shard >= 0")
    if table is None:
        replies = asked.groupBy("shard").applyInArrow(respond_alone, SCHEMA)
    else:
        replies = asked.groupBy("shard").cogroup(table.groupBy("shard")).applyInArrow(respond, SCHEMA)
    return sent.where("shard < 0").unionByName(replies).groupBy("parcel").applyInArrow(close, schema)


def send(docs: DataFrame, scan: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], name: str) -> DataFrame:
    """The saved rows() of every parcel that scan makes of docs."""
    return save(docs.mapInArrow(lean(scan), SCHEMA), name)


def shard_of(key: str, bits: int):
    """Shard of a signed 64-bit key column."""
    return F.shiftrightunsigned(F.col(key), 64 - bits).cast("int")
