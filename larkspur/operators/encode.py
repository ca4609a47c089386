"""Category codes: sorted distinct texts become 0, 1, 2, ...; an unseen text takes the first code."""

from pyspark.sql import functions as F

from larkspur.operators.ranking import row_number_by_range
from larkspur.session import small_table

# Codes of a column up to this size travel inside the plan, up to the next one as a broadcast table;
# a larger code table is an ordinary join.
INLINE_LIMIT = 64
BROADCAST_LIMIT = 100_000
#: Frequent values of a wide column that travel in the plan, and values that the sketch keeps apart.
FREQUENT, TRACKED = 32, 4_096
#: Bytes of bitmaps for each row, beyond which numbers are too far apart for them.
DENSE = 8
CODE_SCHEMA = "column string, value string, code int"


def _long(df, columns):
    """(column, value) pairs of the text columns."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return df.select(F.explode(pairs).alias("p")).select("p.*").where("value is not null")


def distinct_values(df, columns):
    return _long(df, columns).distinct()


def wide_code_table(df, columns):
    """(column, value, code) of columns with very many values, numbered by many tasks."""
    numbered = row_number_by_range(distinct_values(df, columns), ["column"], ["value"], "_place")
    return numbered.select("column", "value", (F.col("_place") - 1).cast("int").alias("code"))


def code_table(df, columns, limit=None):
    """(column, value, code) of any columns; only small ones pass through the driver."""
    codes = fit_codes(df, columns, BROADCAST_LIMIT if limit is None else limit)
    return codes.to_table(df.sparkSession)


def cardinality(df, columns):
    """Number of distinct values per column."""
    return distinct_values(df, columns).groupBy("column").agg(F.count(F.lit(1)).alias("n_values"))


def distinct_whole_numbers(df, columns, bytes_per_value=DENSE):
    """Exact number of distinct whole numbers per column: (column, n_values).

    Numbers are bits: tasks set them in bitmaps of 32,768 neighbouring numbers, which are merged by OR, so no pair of column
    and value is shuffled. That pays where numbers lie close, as keys and codes do; a column whose range would need more
    than ``bytes_per_value`` bytes of bitmaps a row is counted by its values.
    """
    columns = list(columns)
    if not columns:
        return small_table(df.sparkSession, [], "column string, n_values long")
    longs = df.select(*[F.col(c).cast("long").alias(c) for c in columns])
    ends = longs.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("n", F.count), ("low", F.min), ("high", F.max))]).first()
    dense = [c for c in columns if ends[f"n_{c}"] and (ends[f"high_{c}"] - ends[f"low_{c}"]) // 8 <= max(
        bytes_per_value * ends[f"n_{c}"], 1 << 20)]
    out = small_table(df.sparkSession, [(c, 0) for c in columns if not ends[f"n_{c}"]], "column string, n_values long")
    if dense:
        numbers = F.array(*[F.struct(F.lit(c).alias("column"), (F.col(c) - F.lit(ends[f"low_{c}"]) + 1).alias("v")) for c in dense])
        pairs = longs.select(F.explode(numbers).alias("p")).select("p.*").where("v is not null")
        maps = pairs.groupBy("column", F.bitmap_bucket_number("v").alias("bucket")).agg(
            F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("v"))).alias("n"))
        out = out.unionByName(maps.groupBy("column").agg(F.sum("n").alias("n_values")))
    sparse = [c for c in columns if ends[f"n_{c}"] and c not in dense]
    return out.unionByName(cardinality(longs, sparse)) if sparse else out


def frequent_values(df, columns, k=FREQUENT, tracked=TRACKED, share=1 / 64):
    """Column -> values that hold at least about ``share`` of its rows, at most ``k``, by one pass with sketches of
    fixed size. Nothing depends on the estimates but how rows travel."""
    columns = list(columns)
    if not columns or df.isStreaming:
        return {}
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    row = texts.agg(F.count(F.lit(1)).alias("_rows"), *[
        F.expr(f"approx_top_k(`{c}`, {k}, {tracked})").alias(c) for c in columns]).first()
    return {c: [x["item"] for x in row[c] or () if x["item"] is not None and x["count"] >= share * row["_rows"]] for c in columns}


class Codes:
    """Fitted codes: value lists of the small columns, a table for the large ones."""

    def __init__(self, lists, table=None, wide=()):
        self.lists, self.table, self.wide = lists, table, tuple(wide)

    def of(self, name, values):
        """Value -> code of a few values of a wide column; a value without a code is absent."""
        if not values:
            return {}
        found = self.table.where((F.col("column") == name) & F.col("value").isin(*values))
        return {r["value"]: r["code"] for r in found.collect()}

    @property
    def columns(self):
        return [*self.lists, *self.wide]

    def to_table(self, spark):
        rows = [(c, v, i) for c, values in self.lists.items() for i, v in enumerate(values)]
        small = small_table(spark, rows, CODE_SCHEMA)
        return small if self.table is None else small.unionByName(self.table)


def fit_codes(df, columns, limit=BROADCAST_LIMIT):
    """One pass when no column has more than ``limit`` values; larger columns get a table."""
    columns = list(columns)
    if not columns:
        return Codes({})
    values = distinct_values(df, columns)
    found = values.limit(limit + 1).collect()
    wide = []
    if len(found) > limit:
        sizes = values.groupBy("column").count().collect()
        wide = [r["column"] for r in sizes if r["count"] > limit]
        rest = [c for c in columns if c not in wide]
        found = distinct_values(df, rest).collect() if rest else []
    lists = {c: [] for c in columns if c not in wide}
    for r in found:
        lists[r["column"]].append(r["value"])
    lists = {c: sorted(texts) for c, texts in lists.items()}
    return Codes(lists, wide_code_table(df, wide) if wide else None, wide)


def apply_codes(df, codes, columns=None, unseen=0, frequent=None):
    """Replace texts by codes as doubles, in place; ``unseen`` is the code of values not fitted.

    Columns with a code table are joined with it. Their ``frequent`` values (found by a sketch of ``df``, or given as
    column -> values) are coded in the plan: rows whose wide columns hold frequent values only don't enter a join,
    and in other rows a frequent value is no key of it, so no task gets the rows of a hot value.
    """
    columns = [c for c in codes.columns if c in (columns or df.columns)]
    inline = {}
    for c in columns:
        values = codes.lists.get(c)
        if values is not None and len(values) <= INLINE_LIMIT:
            inline[c] = _inline(F.col(c).cast("string"), values, unseen)
    out = df.withColumns(inline)
    for c in [c for c in columns if c not in inline and c in codes.lists]:
        out = _joined(out, c, codes, unseen)
    wide = [c for c in columns if c in codes.wide]
    if not wide:
        return out
    frequent = frequent_values(df, wide) if frequent is None else frequent
    known = {c: _frequent_codes(codes.of(c, frequent.get(c)), frequent.get(c) or (), unseen) for c in wide}
    return _wide_joined(out, wide, codes, known, unseen)


def _frequent_codes(found, values, unseen):
    return {v: float(found.get(v, unseen)) for v in values}


def _wide_joined(df, wide, codes, known, unseen):
    in_plan = {c: F.when(F.col(c).cast("string").isin(*known[c]), F.lit(True)).otherwise(F.lit(False)) if known[c] else F.lit(False)
               for c in wide}
    coded = {c: F.try_element_at(F.create_map(*[F.lit(x) for p in known[c].items() for x in p]), F.col(c).cast("string"))
             if known[c] else F.lit(None).cast("double") for c in wide}
    every = F.lit(True)
    for c in wide:
        every = every & in_plan[c]
    tail = df.where(~every)
    for c in wide:
        side = codes.table.where(F.col("column") == c).select(F.col("code").alias("_code"), F.col("value").alias("_value"))
        # A frequent value, or none at all, becomes a key that no code has; copies of it are spread.
        spread = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*df.columns), F.lit(1 << 16)).cast("string"))
        key = F.when(in_plan[c] | F.col(c).isNull(), spread).otherwise(F.col(c).cast("string"))
        tail = tail.withColumn("_key", key).join(side, F.col("_key") == F.col("_value"), "left").withColumn(
            f"_coded_{c}", F.coalesce(coded[c], F.col("_code").cast("double"), F.lit(float(unseen)))).drop("_key", "_code", "_value")
    tail = tail.select(*[F.col(f"_coded_{c}").alias(c) if c in wide else F.col(c) for c in df.columns])
    if not all(known.values()):
        return tail
    return df.where(every).withColumns(coded).unionByName(tail)


def _inline(c, values, unseen):
    if not values:
        return F.lit(float(unseen))
    pairs = [F.lit(x) for i, v in enumerate(values) for x in (v, float(i))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), F.lit(float(unseen)))


def _joined(df, name, codes, unseen):
    rows = list(enumerate(codes.lists[name]))
    side = F.broadcast(small_table(df.sparkSession, rows, "_code int, _value string"))
    joined = df.join(side, F.col(name).cast("string") == F.col("_value"), "left")
    coded = F.coalesce(F.col("_code").cast("double"), F.lit(float(unseen)))
    return joined.withColumn(name, coded).select(*df.columns)


def unseen_report(df, table, columns):
    """Counts of values that have no code; equal values are counted before the join."""
    counts = _long(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(table, ["column", "value"], "left_anti")
