"""Helpers shared by the operators: table reading, Arrow passes, words and hashes."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Bytes that end a word, as one translation of UTF-8 text: A-Z becomes a-z, the rest stays.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# As LOWER, and every ASCII byte that is neither a letter nor a digit becomes a space.
LOWER_ALNUM = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def crc_mod(column: str, modulus: int):
    """crc32 of an id's decimal text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def crc_of(value: object) -> int:
    """The same crc32 for a Python value."""
    return zlib.crc32(b"" if value is None else str(value).encode())


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def space_words(text: str | None) -> list[bytes]:
    """Lower-cased words between the six ASCII white-space bytes (what ``bytes.split`` splits on)."""
    return text.encode().translate(LOWER).split() if text else []


def alnum_words(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and non-ASCII characters."""
    return text.encode().translate(LOWER_ALNUM).split() if text else []


def bounded_sample(rows: DataFrame, key: str, bound: int) -> DataFrame:
    """All rows where there are no more than ``bound``, else about that many, chosen by a hash of the key.

    The expected number is the bound; no task or driver sorts the rest.
    """
    total, slots = rows.count(), 1 << 40
    if total <= bound:
        return rows
    return rows.where(F.pmod(F.xxhash64(key), F.lit(slots)) < int(slots * bound / total))


Step = Callable[..., Iterator[dict] | dict | None]


def map_batches(df: DataFrame, columns: list, schema: StructType | str, make: Callable[[], Step]) -> DataFrame:
    """One Arrow pass: ``make()`` runs once a task and returns ``step(*lists)``, which gets the
    chosen columns of a batch as lists and returns a dict of equally long sequences.

    Batches are bounded in rows and bytes by the session, so a task's memory does not follow
    its partition. A step may carry a ``finish`` attribute, called once after the last batch.
    """
    wanted = df.select(*columns)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    arrow = to_arrow_schema(schema)

    def run(batches):
        step = make()

        def pack(out):
            arrays = [v if isinstance(v, pa.Array) else pa.array(v, type=f.type) for f, v in
                      ((f, out[f.name]) for f in arrow)]
            return pa.RecordBatch.from_arrays(arrays, schema=arrow)

        for batch in batches:
            if batch.num_rows:
                out = step(*(column.to_pylist() for column in batch.columns))
                if out is not None:
                    yield pack(out)
        finish = getattr(step, "finish", None)
        out = finish() if finish else None
        if out is not None:
            yield pack(out)

    return wanted.mapInArrow(run, schema)
