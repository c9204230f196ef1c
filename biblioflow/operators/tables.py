"""Relational operators: numbering, last-wins, mode, nesting, merging, gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from biblioflow.functions import ids, pages
from biblioflow.session import checkpoint


def last_wins(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key, the one with the greatest ``order`` (null keys are one key).

    A plain aggregation with a partial step before the shuffle; no window, so a key
    that holds a third of all rows sends one row per input partition.
    """
    rest = [c for c in df.columns if c != key]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.struct(*rest).alias("_r"))
    best = df.groupBy(F.col(key)).agg(F.max(packed).alias("_m"))
    return best.select(key, *[F.col("_m._r")[c].alias(c) for c in rest])


def _ranged(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` in range partitions, written, with the partition (_part) and the place in it (_at) of every row."""
    part, local = F.spark_partition_id(), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return checkpoint(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"_part": part, "_at": local}))


def number_rows(df: DataFrame, order: list[Column], name: str = "seq", start: int = 1) -> DataFrame:
    """Numbers rows 1, 2, ... in a total order without gathering them in one task.

    Rows are range-partitioned and sorted, written to the checkpoint folder, and the
    sizes of the partitions (one row each) give every partition its offset.
    """
    ranged = _ranged(df, order)
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    numbered = ranged.join(F.broadcast(offsets), "_part")
    return numbered.withColumn(name, F.col("_before") + F.col("_at") + F.lit(start)).drop("_part", "_at", "_n", "_before")


def number_within(df: DataFrame, group: str, order: list[Column], name: str = "seq") -> DataFrame:
    """Numbers rows from 1 in each group (null is one), whatever share of the rows a group holds.

    Range partitions by group and order cut a large group into several; rows are
    counted inside each and what a group has in earlier partitions is added. Only
    groups that straddle partitions have such an offset, so these are few rows.
    """
    ranged = _ranged(df, [F.col(group).asc_nulls_first(), *order])
    sizes = ranged.groupBy("_part", group).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    late = sizes.select("_part", F.col(group).alias("_g"), F.sum("_n").over(w).alias("_before")).where("_before > 0")
    local = F.row_number().over(Window.partitionBy("_part", group).orderBy("_at"))
    numbered = ranged.withColumn("_k", local)
    numbered = numbered.join(F.broadcast(late.withColumnRenamed("_part", "_p")), (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")), "left")
    return numbered.withColumn(name, (F.coalesce("_before", F.lit(0)) + F.col("_k")).cast("bigint")).drop("_part", "_at", "_k", "_p", "_g", "_before")


def make_unique(df: DataFrame, name: str, order: list[Column], out: str) -> DataFrame:
    """The k-th repeat of a name gets '-k'; the first stays bare."""
    k = F.col("_no") - 1
    numbered = number_within(df, name, order, "_no")
    return numbered.withColumn(out, F.when(k == 0, F.col(name)).otherwise(F.concat(F.col(name), F.lit("-"), k.cast("string")))).drop("_no")


def most_common(df: DataFrame, value: str, order: list[str]) -> DataFrame:
    """(value, n): the most frequent non-null value; of equals the one met first. One row or none."""
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"), F.min(F.struct(*order)).alias("_first"))
    return counts.orderBy(F.desc("n"), "_first").limit(1).select(value, "n")


def carry_forward(df: DataFrame, value: str, order: list[Column], out: str, group: str | None = None) -> DataFrame:
    """The last non-null value up to a row, '' before the first.

    With ``group`` (an issue, say) every group is a window of its own. Without it the
    table is one ordered sequence in range partitions: each is filled by itself, and
    starts with the last value of those before it (one row for each partition).
    """
    up = Window.unboundedPreceding
    if group:
        w = Window.partitionBy(group).orderBy(*order).rowsBetween(up, Window.currentRow)
        return df.withColumn(out, F.coalesce(F.last(value, ignorenulls=True).over(w), F.lit("")))
    ranged = _ranged(df, order)
    last = ranged.groupBy("_part").agg(F.max(F.when(F.col(value).isNotNull(), F.struct("_at", value)))[value].alias("_v"))
    earlier = last.select("_part", F.last("_v", ignorenulls=True).over(Window.orderBy("_part").rowsBetween(up, -1)).alias("_before"))
    own = F.last(value, ignorenulls=True).over(Window.partitionBy("_part").orderBy("_at").rowsBetween(up, Window.currentRow))
    filled = ranged.withColumn("_own", own).join(F.broadcast(earlier), "_part")
    return filled.withColumn(out, F.coalesce("_own", "_before", F.lit(""))).drop("_part", "_at", "_own", "_before")


def assign_sections(nodes: DataFrame, group: str, pos: str, tag: str) -> DataFrame:
    """Table nodes with the position of the heading whose run of tables they belong to.

    A run starts at a heading (h4) and ends at the first node that is neither heading nor table.
    """
    up = Window.partitionBy(group).orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    head = F.last(F.when(F.col(tag) == "h4", F.col(pos)), ignorenulls=True).over(up)
    marked = nodes.withColumn("head_pos", head)
    run = Window.partitionBy(group, "head_pos").orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    broken = F.max(F.when(F.col(tag).isin("h4", "table"), 0).otherwise(1)).over(run)
    return marked.withColumn("_broken", broken).where((F.col(tag) == "table") & F.col("head_pos").isNotNull() & (F.col("_broken") == 0)).drop("_broken")


def nest(parents: DataFrame, children: DataFrame, key: str, order: list[str], fields: list[str], out: str) -> DataFrame:
    """Parents with an ordered array of their children; a parent without any gets an empty array."""
    item = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], *[F.col(f) for f in fields])
    lists = children.groupBy(key).agg(F.sort_array(F.collect_list(item)).alias("_l"))
    plain = F.transform("_l", lambda x: F.struct(*[x[f].alias(f) for f in fields]))
    joined = parents.join(lists.select(key, plain.alias(out)), key, "left")
    return joined.withColumn(out, F.coalesce(out, F.expr("filter(array(), x -> true)").cast(joined.schema[out].dataType)))


def unnest(df: DataFrame, array: str, keep: list[str], order: str = "item_order") -> DataFrame:
    """One row per item with its position from 1; empty arrays give none."""
    flat = df.select(*keep, F.posexplode(array).alias("_p", "_x"))
    fields = df.schema[array].dataType.elementType.names
    return flat.select(*keep, (F.col("_p") + 1).cast("bigint").alias(order), *[F.col("_x")[f].alias(f) for f in fields])


def append_item(df: DataFrame, array: str, item: Column) -> DataFrame:
    return df.withColumn(array, F.array_append(array, item))


def project(df: DataFrame, headers: dict[str, str], constants: dict[str, Column] | None = None) -> DataFrame:
    """Named output columns as text, '' for null and for columns that are not there; constants win."""
    constants = constants or {}
    have = set(df.columns)

    def one(name: str, source: str) -> Column:
        if name in constants:
            return constants[name].alias(name)
        return (F.coalesce(F.col(source).cast("string"), F.lit("")) if source in have else F.lit("")).alias(name)

    return df.select(*[one(n, s) for n, s in headers.items()])


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Columns under their other names (a record's field names to column names or back); the rest passes through."""
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def objects(array: Column) -> Column:
    """The items of an array that are objects; an absent array gives null, items of another kind were read as null."""
    return F.filter(array, lambda x: x.isNotNull())


def is_empty(df: DataFrame, column: str) -> Column:
    """Null, '' and an empty array are empty; 0 and false are not."""
    kind = df.schema[column].dataType.typeName()
    c = F.col(column)
    if kind == "array":
        return c.isNull() | (F.size(c) == 0)
    return c.isNull() | (c == "") if kind == "string" else c.isNull()


def has_empty_fields(df: DataFrame, ignore: tuple[str, ...] = ("first_pages", "last_pages", "references")) -> Column:
    test = F.lit(False)
    for c in df.columns:
        if c not in ignore:
            test = test | is_empty(df, c)
    return test


def needs_completion(df: DataFrame, titles: tuple[str, str], section: str) -> Column:
    """Titled rows outside editorials that lack a field."""
    titled = F.coalesce(F.col(titles[0]), F.lit("")) != ""
    titled = titled | (F.coalesce(F.col(titles[1]), F.lit("")) != "")
    return titled & ~F.col(section).eqNullSafe("EDT") & has_empty_fields(df)


def merge(site: DataFrame, documents: DataFrame, host: str = "doi.org", prefix: str = "", year: Column | None = None) -> DataFrame:
    """Site rows joined to their documents; the document's fields replace the site's, even when empty.

    site(id_jems, seq, section, title2, first_page, doi); documents(id_jems,
    title_orig, num_pages), one row per id. Rows without a partner vanish. Key,
    section, first page and DOI stay the site's; the page range comes from both.
    """
    both = site.join(documents, "id_jems")
    doi = ids.complete_doi(F.col("doi"), F.lit(prefix), year if year is not None else F.lit(""), F.col("first_page"), host)
    return both.select(
        "id_jems", "seq", "section", "title_orig", F.col("title2").alias("title_orig2"), "first_page",
        pages.page_range(F.col("first_page"), F.col("num_pages")).alias("pages"), doi.alias("doi"), F.col("num_pages").cast("bigint").alias("num_pages"),
    )


def chunks(df: DataFrame, order: list[Column], line: Column, size: int = 20, header: str = "") -> DataFrame:
    """(chunk, n, body): rows in order, ``size`` to a chunk, their lines below the header, joined by line breaks."""
    numbered = number_rows(df.withColumn("_line", line), order, "_pos")
    grouped = numbered.withColumn("chunk", F.floor((F.col("_pos") - 1) / size)).groupBy("chunk")
    lines = F.transform(F.sort_array(F.collect_list(F.struct("_pos", "_line"))), lambda x: x["_line"])
    return grouped.agg(F.count("*").alias("n"), F.concat(F.lit(header + "\n" if header else ""), F.array_join(lines, "\n")).alias("body"))


def replace_by_mapping(left: DataFrame, column: str, mapping: DataFrame, key: str, new: str) -> DataFrame:
    """Left join on a column, null matching null; the new value replaces the old, null where none is listed.

    Repeated keys of the mapping repeat rows.
    """
    right = mapping.select(F.col(key).alias("_k"), F.col(new).alias("_v"))
    joined = left.join(right, left[column].eqNullSafe(F.col("_k")), "left")
    return joined.withColumn(column, F.col("_v")).drop("_k", "_v")


def missing(wanted: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not present yet."""
    return wanted.join(present.select(key), key, "left_anti")
