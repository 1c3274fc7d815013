"""Exact duplicates by deterministic block naming.

A text without white space is cut into blocks of a fixed size. All distinct blocks of the corpus are sorted (within
buckets of a hash, so that the sort is spread evenly) and a block's name is its place in that order, an integer. Then
adjacent names are paired and the distinct pairs sorted and named in the same way, level by level, until every text has
one name. Two texts have the same number of levels and the same last name if and only if they are equal: bytes are
compared, hashes only say where.

Copies: a task keeps the blocks it has met in a dictionary of bounded size and hands out each of them once, so a block
that a third of all rows share is one row per dictionary (32 MB of distinct text) in the sort, and rows look their names
up by dictionary. Pairs and groups are likewise reduced to one row per source partition before they meet.

Edge cases: a null text is empty; all texts without a character that counts are equal. Repeated rows (equal text and id)
are members like others, and the first of them stays. A null id ranks behind all ids, so its row stays only in a group
without ids or as the longest; keep_id is then null. An empty table gives an empty result. Other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from eventloom.llm.rows import free_name
from eventloom.llm.stored import stored
from eventloom.llm.words import release, slices

WHITE = b" \t\n\x0b\x0c\r"
BLOCK_BYTES = 8192
#: A task's dictionary of blocks is closed and a new one begun after so many bytes; an entry counts as ENTRY_BYTES more.
BOOK_BYTES = 32 << 20
ENTRY_BYTES = 128
#: A name is a bucket (16 bits of a hash) and a place in it (40 bits); a text's identity has the level above that.
PLACE_BITS, BUCKET_BITS = 40, 16


def _catalogued(docs: DataFrame, text: str, identifier: str, keep: list[str], block: int) -> DataFrame:
    """A row per document: its key, the columns of `keep` as a struct, code points, SHA-256, number of its dictionary
    (`book`), the dictionary's numbers of its blocks (`ids`) and those blocks that it is the first to hold (`fresh`,
    numbered from `first_new`)."""
    source = docs.select(
        F.monotonically_increasing_id().alias("key"),
        F.struct(*[docs[f"`{c}`"] for c in keep]).alias("row"),
        docs[f"`{identifier}`"].cast("long").alias("id"),
        docs[f"`{text}`"].cast("string").alias("text"),
    )
    kinds = {"points": T.LongType(), "sha": T.BinaryType(), "book": T.LongType(), "first_new": T.IntegerType()}
    kinds |= {"ids": T.ArrayType(T.IntegerType()), "fresh": T.ArrayType(T.BinaryType())}
    schema = T.StructType([*source.schema.fields[:3], *[T.StructField(c, kind) for c, kind in kinds.items()]])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, known, size = None, {}, 0
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column(3)
                found = []
                for key, raw in zip(part.column(0).to_pylist(), texts.cast(pa.large_binary()).to_pylist()):
                    if book is None or size > BOOK_BYTES:
                        book, known, size = key, {}, 0
                    plain = (raw or b"").translate(None, WHITE)
                    first, ids, fresh = len(known), [], []
                    for at in range(0, len(plain) or 1, block):
                        piece = plain[at : at + block]
                        n = known.setdefault(piece, len(known))
                        if n == first + len(fresh):
                            fresh.append(piece)
                            size += len(piece) + ENTRY_BYTES
                        ids.append(n)
                    found.append((hashlib.sha256(plain).digest(), book, first, ids, fresh))
                columns = [*part.columns[:3], pc.fill_null(pc.utf8_length(texts), 0), *map(list, zip(*found))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) if isinstance(c, list) else c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow
                )
        release()

    return source.mapInArrow(run, schema)


def _named(rows: DataFrame, by: list[str], keep: list[str]) -> DataFrame:
    """Columns `keep` of rows and the name of each row's `by`: equal names if and only if equal values."""
    hashed = rows.select(*keep, *[F.col(c).alias(f"by_{k}") for k, c in enumerate(by)], F.xxhash64(*by).alias("h"))
    hashed = hashed.withColumn("bucket", F.shiftrightunsigned("h", 64 - BUCKET_BITS))
    values = [f"by_{k}" for k in range(len(by))]
    ordered = hashed.repartition("bucket").sortWithinPartitions("h", *values)
    schema = T.StructType([*[rows.schema[c] for c in keep], T.StructField("name", T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        last, place = None, 0  # the row before, and its place in its bucket
        for batch in batches:
            if not batch.num_rows:
                continue
            bucket = batch.column(batch.schema.get_field_index("bucket")).to_numpy()
            rest = [batch.column(batch.schema.get_field_index(v)) for v in values]
            new = np.ones(len(bucket), bool)
            for k, column in enumerate(rest):
                changed = pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
                new[1:] = changed if k == 0 else new[1:] | changed
            if last is not None:
                new[0] = last[1:] != tuple(c[0].as_py() for c in rest)
            begins = np.ones(len(bucket), bool)
            begins[1:] = bucket[1:] != bucket[:-1]
            begins[0] = last is None or last[0] != bucket[0]
            count = np.cumsum(new)  # distinct values so far, this batch
            base = np.maximum.accumulate(np.where(begins, count, 0))
            places = count - base + np.where(base == 0, place, 0)
            place, last = int(places[-1]), (int(bucket[-1]), *(c[-1].as_py() for c in rest))
            names = (bucket << PLACE_BITS) + places
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(len(keep))], pa.array(names)], schema=arrow)
        release()

    return ordered.mapInArrow(run, schema)


def spread_join(rows: DataFrame, table: DataFrame, on: list[str], shard: str) -> DataFrame:
    """rows joined with a table of one row per value of `on`. The table's row goes once to each shard that holds the
    value, so rows of one value meet by shard and not all in one task."""
    wanted = rows.select(*on, shard).distinct().join(table, on)
    return rows.join(wanted, [*on, shard])


def _identities(found: DataFrame, longest: int) -> DataFrame:
    """(key, identity) of all rows of _catalogued, whose longest text has `longest` blocks."""
    blocks = found.select("book", "first_new", F.posexplode("fresh").alias("k", "block"))
    blocks = blocks.select("book", (F.col("first_new") + F.col("k")).alias("id_in_book"), "block")
    names = stored(_named(blocks, ["block"], ["book", "id_in_book"]))
    at = found.select("key", F.size("ids").alias("left"), "book", F.posexplode("ids").alias("pos", "id_in_book"))
    state = at.join(names, ["book", "id_in_book"]).select("key", "left", "pos", "name")
    identity = lambda level: F.shiftleft(F.lit(level).cast("long"), PLACE_BITS + BUCKET_BITS).bitwiseOR(F.col("name"))
    done, level = [], 0
    while True:
        state = stored(state)
        done.append(state.filter("left = 1").select("key", identity(level).alias("identity")))
        if longest == 1:
            break
        level, longest = level + 1, (longest + 1) // 2
        side = lambda k: F.max(F.when(F.col("pos") % 2 == k, F.col("name")))
        pairs = state.filter("left > 1").groupBy("key", "left", F.shiftright("pos", 1).alias("pos"))
        pairs = pairs.agg(side(0).alias("a"), F.coalesce(side(1), F.lit(-1)).alias("b"))
        pairs = pairs.withColumn("shard", F.shiftright("key", 33))
        named = _named(pairs.select("a", "b", "shard").distinct(), ["a", "b"], ["a", "b", "shard"])
        state = pairs.join(named, ["a", "b", "shard"]).select("key", F.expr("(left + 1) div 2").cast("int").alias("left"), "pos", "name")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def grouped(docs: DataFrame, text: str = "text", identifier: str = "doc_id", keep: list[str] | None = None, block: int = BLOCK_BYTES) -> tuple[DataFrame, str]:
    """The rows of docs (columns `keep`, all by default) with a struct: identity, keep_id, group_size, kept,
    text_sha256. Of equal texts the row with the most code points stays, then that of the smallest id. Returns the
    DataFrame and the struct's name."""
    keep = docs.columns if keep is None else keep
    name = free_name(keep, "copies")
    found = stored(_catalogued(docs, text, identifier, keep, block))
    longest = found.agg(F.max(F.size("ids"))).first()[0] or 1
    rows = found.select("key", F.shiftright("key", 33).alias("shard"), "row", "id", "points", "sha")
    rows = stored(rows.join(_identities(found, longest), "key"))
    # Smaller ids and keys first: a bitwise complement turns the order round without overflow.
    order = F.struct("points", F.col("id").isNotNull().alias("named"), F.bitwise_not("id").alias("i"), F.bitwise_not("key").alias("k"), "id")
    groups = rows.groupBy("identity").agg(F.count(F.lit(1)).alias("group_size"), F.max(order).alias("best"))
    joined = spread_join(rows, groups, ["identity"], "shard")
    fields = (
        F.col("identity"),
        F.col("best.id").alias("keep_id"),
        F.col("group_size"),
        (F.col("key") == F.bitwise_not("best.k")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
    return joined.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], F.struct(*fields).alias(name)), name


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """One row of each group of equal texts, with the columns of docs."""
    found, name = grouped(docs, **options)
    return found.filter(F.col(f"{name}.kept")).drop(name)
