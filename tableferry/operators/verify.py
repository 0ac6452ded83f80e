"""Checks that a load was right. Each returns a frame with ``passed``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.mapping import convert, loses, schema_differences
from tableferry.functions.nested import MICROSECOND_TEXT, is_nested, quoted
from tableferry.session import empty_frame


PATH_SCHEMA = "path string, source_type string, target_type string, issue string, lossy_rows bigint"
#: Bits of a key's hash per level of the digest tree.
TREE_BITS = 8
#: Nested values are compared as JSON text that leaves nothing out.
EVERYTHING = {"ignoreNullFields": "false", **MICROSECOND_TEXT}


def verify_counts(source: DataFrame, target: DataFrame, before: int = 0) -> DataFrame:
    """Rows of both sides in one job. ``before`` is what an appended-to target held already."""
    zero = F.lit(0).cast("bigint")
    sides = source.agg(F.count("*").alias("source_rows"), zero.alias("target_rows")).unionByName(
        target.agg(zero.alias("source_rows"), F.count("*").alias("target_rows"))
    )
    difference = F.abs(F.col("source_rows") + F.lit(before) - F.col("target_rows"))
    return (
        sides.agg(F.sum("source_rows").alias("source_rows"), F.sum("target_rows").alias("target_rows"))
        .withColumn("difference", difference)
        .withColumn("passed", F.col("difference") == 0)
    )


def _comparable(column: Column, data_type: T.DataType) -> Column:
    """One type per family, so that a widened number still compares equal."""
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType)):
        return column.cast("bigint")
    if isinstance(data_type, T.FloatType):
        return column.cast("double")
    if isinstance(data_type, T.MapType):
        return F.to_json(F.array_sort(F.map_entries(column)), EVERYTHING)
    if is_nested(data_type):
        return F.to_json(column, EVERYTHING)
    return column


def comparable_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Columns by name in a fixed order and in types that can be hashed and grouped."""
    chosen = sorted(columns or df.columns)
    return df.select(*[_comparable(quoted(c), df.schema[c].dataType).alias(c) for c in chosen])


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of a row. Hashing skips nulls, so which columns are null is hashed too."""
    columns = [quoted(c) for c in df.columns]
    return F.xxhash64(*columns, *[c.isNull() for c in columns])


def table_checksum(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Row count and two order-free digests in one row; combined before the one-row shuffle."""
    rows = comparable_rows(df, columns)
    return rows.select(row_hash(rows).alias("h")).agg(
        F.count("*").alias("rows"),
        # A 64-bit sum would overflow; a decimal one does not.
        F.coalesce(F.sum(F.col("h").cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias("hash_sum"),
        F.coalesce(F.bit_xor("h"), F.lit(0)).alias("hash_xor"),
    )


def verify_checksum(source: DataFrame, target: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Same rows on both sides, in any order. Columns default to those of the source."""
    columns = columns or source.columns

    def side(df: DataFrame, is_source: bool) -> DataFrame:
        return table_checksum(df, columns).withColumn("is_source", F.lit(is_source))

    def of(name: str, is_source: bool) -> Column:
        return F.max(F.when(F.col("is_source") == is_source, F.col(name)))

    both = side(source, True).unionByName(side(target, False))
    return both.agg(
        of("rows", True).alias("source_rows"),
        of("rows", False).alias("target_rows"),
        of("hash_sum", True).alias("source_hash"),
        of("hash_sum", False).alias("target_hash"),
        ((of("rows", True) == of("rows", False))
         & (of("hash_sum", True) == of("hash_sum", False))
         & (of("hash_xor", True) == of("hash_xor", False))).alias("passed"),
    )


def row_differences(source: DataFrame, target: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows that one side has more often than the other: ``side``, ``copies`` and the row.

    Both directions come from one shuffle. Copies are added up before it, so a
    row that makes up a third of the table travels once per task.
    """
    columns = columns or source.columns
    balance = F.sum("__n")
    both = comparable_rows(source, columns).withColumn("__n", F.lit(1)).unionByName(
        comparable_rows(target, columns).withColumn("__n", F.lit(-1))
    )
    names = [quoted(c) for c in sorted(columns)]
    return (
        both.groupBy(*names)
        .agg(balance.alias("__balance"))
        .filter(F.col("__balance") != 0)
        .select(
            F.when(F.col("__balance") > 0, "source").otherwise("target").alias("side"),
            F.abs("__balance").alias("copies"),
            *names,
        )
    )


def _bucketed(df: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Comparable rows with their hash and, from the hash of the key, their place in the digest tree (``__leaf``)."""
    rows = comparable_rows(df, columns)
    leaf = F.shiftrightunsigned(F.xxhash64(*[_comparable(quoted(k), df.schema[k].dataType) for k in sorted(key)]), 64 - 2 * TREE_BITS)
    return rows.select("*", row_hash(rows).alias("__hash"), leaf.cast("int").alias("__leaf"))


def _differing(source: DataFrame, target: DataFrame, bits: int) -> list[int]:
    """Buckets of ``bits`` leading bits whose digests differ between two sides; at most 2^bits."""
    bucket = F.shiftright("__leaf", 2 * TREE_BITS - bits)
    both = source.select(bucket.alias("b"), "__hash", F.lit(1).alias("n")).unionByName(target.select(bucket.alias("b"), "__hash", F.lit(-1).alias("n")))
    digests = both.groupBy("b").agg(
        F.sum("n").alias("rows"), F.sum(F.col("__hash").cast("decimal(20,0)") * F.col("n")).alias("sum"), F.bit_xor("__hash").alias("xor")
    )
    return [r.b for r in digests.filter("rows <> 0 or sum <> 0 or xor <> 0").select("b").orderBy("b").collect()]


def differing_leaves(source: DataFrame, target: DataFrame, key: list[str], columns: list[str] | None = None) -> list[int]:
    """Leaves of the digest tree under which the two sides differ, at most 65,536.

    The tree has 256 buckets by the leading bits of the key's hash, each with 256
    leaves. One pass compares the buckets: tables that agree shuffle 256 digests
    a task and are done. A second pass goes down into buckets that differ.
    """
    columns = sorted(columns or source.columns)
    left, right = _bucketed(source, key, columns), _bucketed(target, key, columns)
    top = _differing(left, right, TREE_BITS)
    if not top:
        return []
    inside = F.shiftright("__leaf", TREE_BITS).isin(top)
    return _differing(left.filter(inside), right.filter(inside), 2 * TREE_BITS)


def under_leaves(df: DataFrame, key: list[str], columns: list[str], leaves: list[int]) -> DataFrame:
    """Comparable rows of ``df`` under some leaves. No row passes without any."""
    some = F.expr(f"__leaf in ({', '.join(map(str, leaves))})") if leaves else F.lit(False)
    return _bucketed(df, key, columns).filter(some).drop("__hash", "__leaf")


def located_differences(source: DataFrame, target: DataFrame, key: list[str], columns: list[str] | None = None) -> DataFrame:
    """What ``row_differences`` gives, for tables that agree in most rows.

    Only rows under leaves whose digests differ are shuffled and compared. Two
    sides with the same digest of 64-bit row hashes (number, sum, exclusive or)
    under a leaf count as equal there. Rows with a null in the key have leaves too.
    """
    columns = sorted(columns or source.columns)
    leaves = differing_leaves(source, target, key, columns)
    return row_differences(under_leaves(source, key, columns, leaves), under_leaves(target, key, columns, leaves), columns)


def sample_by_key(df: DataFrame, key: list[str], one_in: int) -> DataFrame:
    """The same keys on both sides of a comparison: a share of about ``1 / one_in``, chosen by hash."""
    rows = comparable_rows(df, key)
    chosen = F.xxhash64(*[_comparable(quoted(k), df.schema[k].dataType) for k in rows.columns])
    return df.filter(F.pmod(chosen, F.lit(one_in)) == 0)


def verify_sample(source: DataFrame, target: DataFrame, key: list[str], one_in: int = 1) -> DataFrame:
    """Compare whole rows of sampled keys, all keys by default; one result row."""
    if one_in > 1:
        source, target = sample_by_key(source, key, one_in), sample_by_key(target, key, one_in)
    return _pass_if_none(row_differences(source, target))


def _pass_if_none(differences: DataFrame) -> DataFrame:
    def on(side: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("side") == side, F.col("copies"))), F.lit(0).cast("bigint"))

    return differences.agg(
        on("source").alias("only_in_source"),
        on("target").alias("only_in_target"),
        (F.count("*") == 0).alias("passed"),
    )


def verify_keys(df: DataFrame, key: list[str], required: list[str] | None = None) -> DataFrame:
    """``check, violations, passed``: required columns hold no null and the key does not repeat.

    One scan and one shuffle: nulls are counted per key group on the way.
    """
    required = required or key
    groups = df.groupBy(*[quoted(k) for k in key]).agg(
        F.count("*").alias("__n"), *[F.count_if(quoted(c).isNull()).alias(f"__null{i}") for i, c in enumerate(required)]
    )
    whole_key = F.lit(True)
    for k in key:
        whole_key = whole_key & quoted(k).isNotNull()
    zero = F.lit(0).cast("bigint")
    totals = groups.agg(
        F.count_if((F.col("__n") > 1) & whole_key).alias("__repeated"),
        *[F.coalesce(F.sum(f"__null{i}"), zero).alias(f"__null{i}") for i in range(len(required))],
    )
    checks = [F.struct(F.lit(f"unique({','.join(key)})").alias("check"), F.col("__repeated").alias("violations"))]
    checks += [
        F.struct(F.lit(f"not_null({c})").alias("check"), F.col(f"__null{i}").alias("violations"))
        for i, c in enumerate(required)
    ]
    return totals.select(F.inline(F.array(*checks))).withColumn("passed", F.col("violations") == 0)


def _path_differences(source: T.StructType, target: T.StructType, zone: str) -> list[tuple[str, T.DataType | None, T.DataType | None, str, Column]]:
    """``path, source type, target type, issue, row loses a value there`` for every place where two type trees differ.

    ``reach`` turns a test of the values at a path into one of the whole row:
    true if any of them passes, however many arrays and maps lie between.
    """
    found: list[tuple] = []

    def add(path: str, left, right, issue: str, lossy: Column) -> None:
        found.append((path, left, right, issue, F.coalesce(lossy, F.lit(False))))

    def fields(path: str, left: T.StructType, right: T.StructType, reach) -> None:
        have, want = {f.name: f for f in left.fields}, {f.name: f for f in right.fields}
        for name in [*have, *[n for n in want if n not in have]]:
            here = f"{path}.{name}" if path else name

            def inner(test, name=name):
                return reach(lambda v: test(quoted(name) if v is None else v.getField(name)))

            if name not in want:
                add(here, have[name].dataType, None, "only in source", inner(lambda v: v.isNotNull()))
            elif name not in have:
                missing = F.lit(False) if want[name].nullable else reach(lambda v: F.lit(True) if v is None else v.isNotNull())
                add(here, None, want[name].dataType, "only in target", missing)
            else:
                compare(here, have[name].dataType, want[name].dataType, inner, have[name].nullable and not want[name].nullable, reach)

    def compare(path: str, left: T.DataType, right: T.DataType, reach, required: bool, around) -> None:
        if required:
            name = path.rpartition(".")[2]
            if path.endswith(("]", "}")):  # elements, which are null or not by themselves
                lossy = reach(lambda v: v.isNull())
            else:
                lossy = around(lambda v: quoted(name).isNull() if v is None else v.isNotNull() & v.getField(name).isNull())
            add(path, left, right, "target requires a value", lossy)
        if isinstance(left, T.StructType) and isinstance(right, T.StructType):
            fields(path, left, right, reach)
        elif isinstance(left, T.ArrayType) and isinstance(right, T.ArrayType):
            each = lambda test: reach(lambda v: F.exists(v, test))
            compare(f"{path}[]", left.elementType, right.elementType, each, left.containsNull and not right.containsNull, each)
        elif isinstance(left, T.MapType) and isinstance(right, T.MapType):
            keys = lambda test: reach(lambda v: F.exists(F.map_keys(v), test))
            values = lambda test: reach(lambda v: F.exists(F.map_values(v), test))
            compare(f"{path}{{key}}", left.keyType, right.keyType, keys, False, keys)
            compare(f"{path}{{value}}", left.valueType, right.valueType, values, left.valueContainsNull and not right.valueContainsNull, values)
        elif left.simpleString() != right.simpleString():
            add(path, left, right, "type differs", reach(lambda v: loses(v, convert(v, left, right, zone), left, right)))

    fields("", source, target, lambda test: test(None))
    return found


def schema_diff_nested(source: DataFrame, target: T.StructType, zone: str = "UTC") -> DataFrame:
    """One row per differing path of two type trees, with the number of source rows that lose a value there.

    Paths are spelled ``address.city``, ``items[].price``, ``tags{key}``,
    ``tags{value}``. A column is walked into where both sides nest alike; one
    pass over the data counts all paths.
    """
    differences = _path_differences(source.schema, target, zone)
    if not differences:
        return empty_frame(source.sparkSession, PATH_SCHEMA)
    counts = source.agg(*[F.count_if(lossy).alias(f"__{i}") for i, (*_, lossy) in enumerate(differences)])
    text = lambda kind: F.lit(None if kind is None else kind.simpleString()).cast("string")
    rows = [
        F.struct(F.lit(path).alias("path"), text(left).alias("source_type"), text(right).alias("target_type"), F.lit(issue).alias("issue"), F.col(f"__{i}").alias("lossy_rows"))
        for i, (path, left, right, issue, _) in enumerate(differences)
    ]
    return counts.select(F.inline(F.array(*rows)))


def schema_diff(source: DataFrame, target: T.StructType, zone: str = "UTC") -> DataFrame:
    """One row per differing column, with the number of source rows whose value the target type would lose."""
    differences = schema_differences(source.schema, target)
    schema = "column_name string, source_type string, target_type string, issue string, lossy_rows bigint"
    if not differences:
        return empty_frame(source.sparkSession, schema)
    lossy = []
    for position, (name, _, _, issue) in enumerate(differences):
        if issue == "only in source":
            count = F.count(quoted(name))
        elif issue == "only in target":
            count = F.lit(0).cast("bigint") if target[name].nullable else F.count("*")
        elif issue == "type differs":
            value = quoted(name)
            kinds = source.schema[name].dataType, target[name].dataType
            count = F.count_if(loses(value, convert(value, *kinds, zone), *kinds))
        else:
            count = F.count_if(quoted(name).isNull())
        lossy.append(count.alias(f"__{position}"))
    counts = source.agg(F.count("*").alias("__rows"), *lossy)
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(left).cast("string").alias("source_type"),
            F.lit(right).cast("string").alias("target_type"),
            F.lit(issue).alias("issue"),
            F.col(f"__{position}").alias("lossy_rows"),
        )
        for position, (name, left, right, issue) in enumerate(differences)
    ]
    return counts.select(F.inline(F.array(*rows)))
