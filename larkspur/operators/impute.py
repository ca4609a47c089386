"""Missing values: a word for text, the exact column median for numbers."""

from pyspark.sql import Window, functions as F, types as T

from larkspur.operators.columns import number_columns, text_columns
from larkspur.schema import UNKNOWN
from larkspur.session import new_path

#: Size of the rank sketch; a bracket reaches SPREAD / SKETCH_K to both sides of the half, about four times the
#: sketch's usual error.
SKETCH_K, SPREAD = 4_096, 8
#: A bracket's values up to this number come to the driver; beyond it they are counted in bins.
DRIVER_VALUES, BINS = 50_000, 4_096


def fill_unknown(df, columns=None, word=UNKNOWN):
    return df.fillna(word, subset=list(text_columns(df) if columns is None else columns))


def fill_medians(df, medians):
    """Fill from saved medians; a column whose median is unknown stays as it is."""
    known = {c: v for c, v in medians.items() if v is not None and c in df.columns}
    doubles = df.withColumns({c: F.col(c).cast("double") for c in known})
    return doubles.fillna(known) if known else doubles


def fit_medians(df, columns=None, k=SKETCH_K, bins=BINS):
    """Exact medians of all columns as a dict, NULL and NaN ignored, in two passes over the rows.

    The first pass takes a mergeable rank sketch of fixed size of each column; its quantiles just below and above
    the half bracket the middle ranks. The second pass counts what lies below the bracket, and the values inside it,
    summed up before the shuffle. That table of values, a small share of the rows, is searched for the
    middle ranks. A bracket that has missed its rank, which the counts show, is opened to the side where it lies.
    """
    columns = list(number_columns(df) if columns is None else columns)
    if not columns:
        return {}
    values = df.select(*[_present(df, c).alias(c) for c in columns])
    brackets = _brackets(values, columns, k)
    found = {c: None for c in columns}
    while brackets:
        held = _held(values, brackets)
        middles, brackets = _middles(held, brackets, bins)
        found |= middles
    return found


def _brackets(values, columns, k):
    """Column -> (number of values, low end, high end); None as an end is open."""
    sketched = values.agg(F.count(F.lit(1)).alias("rows"), *[x for c in columns for x in (
        F.count(c).alias(f"n_{c}"), F.kll_sketch_agg_double(c, k).alias(f"s_{c}"))])
    share = min(SPREAD / k, 0.5)
    ends = F.array(F.lit(0.5 - share), F.lit(0.5 + share))
    row = sketched.select("rows", *[x for c in columns for x in (
        F.col(f"n_{c}"), F.when(F.col(f"n_{c}") > 0, F.kll_sketch_get_quantile_double(f"s_{c}", ends)).alias(f"q_{c}"))]).first()
    if not row["rows"]:
        raise ValueError("no rows to take medians of")
    return {c: (row[f"n_{c}"], *row[f"q_{c}"]) for c in columns if row[f"n_{c}"]}


def _held(values, brackets):
    """(t, v, n): per column t the values inside its bracket, and NULL for all below it."""
    cells = []
    for t, (c, (_, low, high)) in enumerate(brackets.items()):
        v = F.col(c)
        below = F.lit(False) if low is None else v < low
        inside = v.isNotNull() if high is None else v <= high
        cells.append(F.when(inside, F.struct(F.lit(t).alias("t"), F.when(~below, v).alias("v"))))
    counted = values.select(F.explode(F.array_compact(F.array(*cells))).alias("x")).select("x.*").groupBy("t", "v").agg(
        F.count(F.lit(1)).alias("n"))
    path = new_path(values.sparkSession, "medians")
    counted.write.parquet(path)
    return values.sparkSession.read.schema("t int, v double, n long").parquet(path)


def _middles(held, brackets, bins):
    """The medians whose ranks lie inside their brackets, and wider brackets for the others."""
    sizes = {r["t"]: r for r in held.groupBy("t").agg(
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("below"),
        F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("n"))), F.lit(0)).alias("inside"),
        F.count("v").alias("values"), F.min("v").alias("low"), F.max("v").alias("high")).collect()}
    todo, missed = [], {}
    for t, (c, (n, low, high)) in enumerate(brackets.items()):
        ranks, r = {(n - 1) // 2, n // 2}, sizes.get(t)
        below, inside = (r["below"], r["inside"]) if r else (0, 0)
        if min(ranks) < below or max(ranks) >= below + inside:
            missed[c] = (n, None if min(ranks) < below else low, None if max(ranks) >= below + inside else high)
        else:
            todo += [(t, rank, r["low"], r["high"], below) for rank in ranks]
    kept, middle = held.where("v is not null"), {}
    if sum(r["values"] for r in sizes.values()) <= DRIVER_VALUES:
        middle = _picked(kept.collect(), todo)
    else:
        while todo:
            middle |= {(t, rank): low for t, rank, low, high, _ in todo if low == high}
            todo = [x for x in todo if x[2] < x[3]]
            todo = _narrowed(kept, todo, bins) if todo else []
    names = list(brackets)
    ends = {c: [v for (t, _), v in middle.items() if names[t] == c] for c in names if c not in missed}
    return {c: (min(v) + max(v)) / 2 for c, v in ends.items()}, missed


def _picked(rows, todo):
    """The values at the ranks, from a bounded number of values with their numbers."""
    rows = sorted((r["t"], r["v"], r["n"]) for r in rows)
    out = {}
    for t, rank, _, _, below in todo:
        for _, v, n in (r for r in rows if r[0] == t):
            below += n
            if rank < below:
                out[t, rank] = v
                break
    return out


def _narrowed(held, todo, bins):
    """Each rank with the range of the bin it falls into. The ends of a range lie in different bins, so every
    step leaves fewer different values."""
    cells = []
    for i, (t, _, low, high, _) in enumerate(todo):
        v = F.col("v")
        # Halves, as the width of a range may exceed the largest number.
        share = (v / 2 - low / 2) / (high / 2 - low / 2)
        cell = F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int")
        cells.append(F.when((F.col("t") == t) & v.between(low, high), F.struct(F.lit(i).alias("i"), cell.alias("cell"))))
    counted = held.select("v", "n", F.explode(F.array_compact(F.array(*cells))).alias("x")).groupBy("x.i", "x.cell").agg(
        F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    upto = F.sum("n").over(Window.partitionBy("i").orderBy("cell"))
    place = F.element_at(F.array(*[F.lit(rank - below) for _, rank, _, _, below in todo]), F.col("i") + 1)
    hits = counted.withColumn("upto", upto).where((F.col("upto") - F.col("n") <= place) & (place < F.col("upto"))).collect()
    return [(todo[r["i"]][0], todo[r["i"]][1], r["low"], r["high"], todo[r["i"]][4] + r["upto"] - r["n"]) for r in hits]


def _present(df, name):
    c = F.col(name).cast("double")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), c)
    return c
