"""The versioned table store: latest states, lineage, idempotent writes, fingerprints, consistency and constraints."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from slatemill.plans.cut import cut


def latest(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row for each key, the greatest in the order (an append-only log's present state); a partial aggregation."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_x")).select(*key, "_x.*")


def either_semi(df: DataFrame, key: str, *sides: tuple[str, DataFrame, str]) -> DataFrame:
    """Rows of df that at least one of (column, other table, its column) matches: one semi join each, their union by key.

    A disjunction in one join condition would be a nested loop; each side here is an equi join.
    """
    ids = None
    for column, other, theirs in sides:
        part = df.join(other.select(F.col(theirs).alias(column)), column, "left_semi").select(key)
        ids = part if ids is None else ids.unionByName(part)
    return df.join(ids.distinct(), key, "left_semi")


def either_side(links: DataFrame, columns: list[str], owners: DataFrame, owner: str, *sides: tuple[str, str]) -> DataFrame:
    """(owner, columns): the links that touch an owner's item on one side or the other, each once; sides: (column of links, column of owners)."""
    out = None
    for column, theirs in sides:
        part = links.join(owners.select(F.col(owner).alias("_o"), F.col(theirs).alias(column)), column).select(F.col("_o").alias(owner), *columns)
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def lineage(edges: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """(start, node, depth) of every ancestor that can be reached over edges (child, parent), at its least depth.

    Known paths are joined with each other, so a round doubles their length and the number of rounds is the logarithm of the
    depth, however deep. The least depth of each pair is kept, so cycles end. A start is no ancestor of itself. Parents without a
    row of their own are kept. starts: (start), all children if None; the closure is then of what can be reached from them.
    """
    edges = edges.select("child", "parent").filter("child is not null and parent is not null and child <> parent").distinct()
    if starts is not None:
        # only what the starts can reach takes part
        reached = cut(starts.select(F.col("start").alias("child")).distinct())
        while True:
            more = cut(edges.join(reached, "child", "left_semi").select(F.col("parent").alias("child")).unionByName(reached).distinct())
            if more.count() == reached.count():
                break
            reached = more
        edges = edges.join(reached, "child", "left_semi")
    paths = cut(edges.select(F.col("child").alias("start"), F.col("parent").alias("node"), F.lit(1).alias("depth")))
    size = paths.agg(F.count("*"), F.sum("depth")).first()
    while size[0]:
        on = paths.select(F.col("start").alias("node"), F.col("node").alias("end"), F.col("depth").alias("more"))
        longer = paths.join(on, "node").filter("start <> end").select("start", F.col("end").alias("node"), (F.col("depth") + F.col("more")).alias("depth"))
        paths = cut(paths.unionByName(longer).groupBy("start", "node").agg(F.min("depth").alias("depth")))
        before, size = size, paths.agg(F.count("*"), F.sum("depth")).first()
        if size == before:
            break
    return paths if starts is None else paths.join(starts.select("start").distinct(), "start", "left_semi")


def ensure(new: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """The rows of new whose key does not exist yet, one for each key: what an idempotent insert adds. Null keys are left out."""
    wanted = new.dropna(subset=key).dropDuplicates(key)
    return wanted.join(existing.select(*key).distinct(), key, "left_anti")


def import_bundle(new: DataFrame, existing: DataFrame, key: str, content: str) -> DataFrame:
    """new with ``outcome``: idempotent (key and content exist), new_revision (key exists with other content) or created."""
    known = existing.groupBy(F.col(key)).agg(F.collect_set(content).alias("_known"))
    outcome = F.when(F.col("_known").isNull(), "created").when(F.array_contains("_known", F.col(content)), "idempotent").otherwise("new_revision")
    return new.join(known, key, "left").withColumn("outcome", outcome).drop("_known")


def fingerprint(df: DataFrame, name: str, columns: list[str] | None = None) -> DataFrame:
    """(table_name, n_rows, content_xor, content_sum): the row count and a hash of all columns that does not depend on the order of rows.

    Two 64-bit halves of each row's hash are combined, one by exclusive or, one by sum, so repeated rows do not cancel out; both
    are partial aggregations. Nested columns count by their JSON text. Null differs from empty.
    """
    columns = columns or df.columns
    flat = [F.coalesce(F.col(c).cast("string") if not isinstance(df.schema[c].dataType, (ArrayType, StructType, MapType)) else F.to_json(F.col(c)), F.lit("\x00")) for c in columns]
    digest = F.md5(F.concat_ws("\x1f", *flat))
    half = lambda k: F.conv(F.substring(digest, k, 15), 16, 10).cast("long")
    return df.select(half(1).alias("a"), half(17).alias("b")).agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows"), F.coalesce(F.bit_xor("a"), F.lit(0)).alias("content_xor"), F.coalesce(F.sum(F.pmod("b", F.lit((1 << 31) - 1))), F.lit(0)).cast("long").alias("content_sum"))


def consistency(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two sets of fingerprints compared: (table_name, left_rows, right_rows, consistent); a table on one side only is inconsistent."""
    a = left.select("table_name", F.col("n_rows").alias("left_rows"), F.struct("content_xor", "content_sum").alias("a"))
    b = right.select("table_name", F.col("n_rows").alias("right_rows"), F.struct("content_xor", "content_sum").alias("b"))
    return a.join(b, "table_name", "full_outer").select("table_name", "left_rows", "right_rows", F.coalesce((F.col("left_rows") == F.col("right_rows")) & (F.col("a") == F.col("b")), F.lit(False)).alias("consistent"))


def row_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows on one side only, as often as they are more there, with ``side`` (left, right)."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))


def unique_violations(df: DataFrame, name: str, key: list[str]) -> DataFrame:
    groups = df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")
    return groups.agg(F.lit(name).alias("constraint_name"), F.count("*").alias("n_violations"))


def check_violations(df: DataFrame, name: str, holds: Column) -> DataFrame:
    """Rows for which the condition is false (null passes, as in SQL)."""
    return df.agg(F.lit(name).alias("constraint_name"), F.count_if(~holds).alias("n_violations"))


def reference_violations(child: DataFrame, column: str, parent: DataFrame, key: str, name: str) -> DataFrame:
    orphans = child.select(F.col(column).alias("_k")).filter("_k is not null").join(parent.select(F.col(key).alias("_k")), "_k", "left_anti")
    return orphans.agg(F.lit(name).alias("constraint_name"), F.count("*").alias("n_violations"))


def cascade(children: DataFrame, column: str, removed: DataFrame, key: str) -> DataFrame:
    """children without those whose parent is removed."""
    return children.join(removed.select(F.col(key).alias(column)), column, "left_anti")


def set_null(children: DataFrame, column: str, removed: DataFrame, key: str) -> DataFrame:
    """children with the reference to a removed parent emptied."""
    gone = removed.select(F.col(key).alias(column)).distinct().withColumn("_gone", F.lit(True))
    return children.join(gone, column, "left").withColumn(column, F.when(F.col("_gone").isNull(), F.col(column))).select(*children.columns)


def upsert(existing: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    """existing with the changed rows in place of those of equal key, and the new ones added; changes has one row a key."""
    return existing.join(changes.select(*key), key, "left_anti").unionByName(changes.select(*existing.columns))


def clone_revision(rows: DataFrame, revision: str, parent: str, old: str, new: str) -> DataFrame:
    """Rows of one revision copied to another, ids and parent links with it: ``old`` at the end of an id becomes ``new``."""
    swap = lambda c: F.regexp_replace(F.col(c), f"\\Q{old}\\E$", new)
    return rows.filter(F.col(revision).endswith(old)).withColumns({revision: swap(revision), parent: swap(parent)})
