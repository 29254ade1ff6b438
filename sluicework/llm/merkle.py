"""WARC records, and an audit of replicas by Merkle trees over offset ranges.

The lowest nodes of a tree hash the records that start in a range of offsets, every
node above hashes ``FAN`` ranges. A missing record therefore changes its own branch
only. Roots are compared, then the children of nodes that differ, down to records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicework.sources.scratch import written_out

#: Bytes of the lowest ranges, and ranges under a node.
SPAN = 1 << 18
FAN = 16

_HEAD = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "
_LENGTH = "\r\nContent-Length: "
_BREAK = "\r\n\r\n"


def warc_record(uri: Column, body: Column) -> Column:
    """A record of a page as bytes; null parts are empty."""
    body, uri = F.coalesce(body, F.lit("")), F.coalesce(uri, F.lit(""))
    return F.encode(
        F.concat(F.lit(_HEAD), uri, F.lit(_LENGTH), F.octet_length(body).cast("string"), F.lit(_BREAK), body, F.lit(_BREAK)),
        "UTF-8",
    )


def warc_layout(pages: DataFrame, files: int) -> DataFrame:
    """``page_id``, ``file``, ``offset``, ``record``: pages one after the other in files,
    by a hash of page_id; in a file by page_id and content."""
    record = warc_record(F.col("url"), F.col("html"))
    digest = F.md5(F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    file = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % files
    placed = pages.select(F.col("page_id").cast("long").alias("page_id"), file.alias("file"), record.alias("record"))
    along = Window.partitionBy("file").orderBy("page_id", F.md5("record")).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.octet_length("record").cast("long")).over(along), F.lit(0))
    return placed.withColumn("offset", offset).select("page_id", "file", "offset", "record")


def _leaves(records: DataFrame) -> DataFrame:
    """Every record's place, length and hash, and how often they occur together."""
    digest = F.coalesce(F.sha2("record", 256), F.lit("null"))
    return written_out(
        records.groupBy(
            F.coalesce(F.col("file").cast("string"), F.lit("")).alias("file"),
            F.coalesce(F.col("offset").cast("long"), F.lit(-1)).alias("offset"),
            F.coalesce(F.octet_length("record"), F.lit(-1)).cast("long").alias("length"),
            digest.alias("digest"),
        ).agg(F.count(F.lit(1)).alias("copies"))
    )


def _hashed(*parts: Column | str) -> Column:
    return F.sha2(F.concat_ws("\n", F.array_sort(F.collect_list(F.concat_ws(":", *parts)))), 256)


def _tree(leaves: DataFrame, levels: int) -> list[DataFrame]:
    """By level from the lowest: ``file``, ``node`` (number of the range), ``digest``."""
    node = F.floor(F.col("offset") / SPAN)
    lowest = leaves.groupBy("file", node.alias("node")).agg(_hashed("offset", "length", "digest", "copies").alias("digest"))
    tree = [written_out(lowest)]
    for _ in range(levels - 1):
        above = F.floor(F.col("node") / FAN)
        tree.append(written_out(tree[-1].groupBy("file", above.alias("node")).agg(_hashed("node", "digest").alias("digest"))))
    return tree


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """``file``, ``node`` whose hashes differ or that one side lacks."""
    mine, other = a.withColumnRenamed("digest", "digest_a"), b.withColumnRenamed("digest", "digest_b")
    return mine.join(other, ["file", "node"], "full").filter(~F.col("digest_a").eqNullSafe(F.col("digest_b"))).select("file", "node")


def _below(level: DataFrame, parents: DataFrame) -> DataFrame:
    parent = F.floor(F.col("node") / FAN)
    above = parents.select(F.col("file").alias("in_file"), F.col("node").alias("in_node"))
    return level.join(above, (F.col("file") == F.col("in_file")) & (parent == F.col("in_node")), "left_semi")


def audit(a: DataFrame, b: DataFrame) -> DataFrame:
    """Records in which replica ``b`` differs from ``a``.

    Both have ``file``, ``offset`` and ``record`` (bytes); other columns are ignored.
    Returns ``file`` (text), ``offset``, ``length_a``, ``length_b`` and ``problem``:
    ``missing`` (only in a), ``extra`` (only in b) or ``changed`` (other bytes or another
    number of copies). Where several different records share an offset, the offset is
    compared as one: lengths are their sums.

    A null file is the file without a name, a null offset is -1, a null record has
    length -1 and differs from an empty one. Repeated records count. Long records are
    hashed whole. If both tables are empty, or equal, there are no rows.
    """
    leaves_a, leaves_b = _leaves(a), _leaves(b)
    last = max(leaves.agg(F.max("offset")).first()[0] or 0 for leaves in (leaves_a, leaves_b))
    levels, top = 1, last // SPAN
    while top > 0:
        levels, top = levels + 1, top // FAN
    tree_a, tree_b = _tree(leaves_a, levels), _tree(leaves_b, levels)
    found = written_out(_differing(tree_a[-1], tree_b[-1]))
    for level in reversed(range(levels - 1)):
        found = written_out(_differing(_below(tree_a[level], found), _below(tree_b[level], found)))

    def in_found(leaves: DataFrame, side: str) -> DataFrame:
        ranges = found.select(F.col("file").alias("in_file"), "node")
        node = F.floor(F.col("offset") / SPAN)
        chosen = leaves.join(ranges, (F.col("file") == F.col("in_file")) & (node == F.col("node")), "left_semi")
        return chosen.groupBy("file", "offset").agg(
            F.sum(F.col("length") * F.col("copies")).alias(f"length_{side}"), _hashed("length", "digest", "copies").alias(f"digest_{side}")
        )

    problem = F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra").otherwise("changed")
    return (
        in_found(leaves_a, "a")
        .join(in_found(leaves_b, "b"), ["file", "offset"], "full")
        .filter(~F.col("digest_a").eqNullSafe(F.col("digest_b")))
        .select("file", "offset", "length_a", "length_b", problem.alias("problem"))
    )
