"""Exact stratified split that a third of all rows under one key cannot slow down.

Every row gets an order text, a digest of its key and the seed. The test rows of a class are its
first k rows in that order, k being the class's share by largest remainder. Sorting whole classes is
not needed to find them: rows are counted by the next digits of the order text, the place where the
quota falls is kept, and only that part is counted again with more digits until it is small. What
reaches the driver is one row per class and step.
"""

import math

from pyspark.sql import Window, functions as F, types as T

from larkspur.operators.ranking import row_number_by_range
from larkspur.session import new_path, small_table

DIGITS = 3
HEAD = 2 * DIGITS
SORT_LIMIT = 1_000_000
CLASS_LIMIT = 10_000
COPY_CHUNK = 100_000


def quotas(counts, test_size):
    """Test rows per class: rounded-up total, largest remainders, ties by class order."""
    total = sum(counts.values())
    wanted = min(total, math.ceil(test_size * total))
    base = {c: wanted * n // total for c, n in counts.items()}
    by_rest = sorted(enumerate(counts), key=lambda e: (-(wanted * counts[e[1]] % total), e[0]))
    for _, c in by_rest[: wanted - sum(base.values())]:
        base[c] += 1
    return base


def with_order(df, key, seed, unique_key, columns):
    """Add ``_head``, leading digits of the key's digest, and ``_order``, the whole order text.

    For keys that are not unique the digest of the whole row follows the head. It costs more, and is
    worked out only where it is asked for.
    """
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key], F.lit(str(seed))))
    if unique_key:
        return df.withColumn("_head", digest).withColumn("_order", F.col("_head"))
    whole_row = F.md5(F.concat_ws("|", *[exact_text(df, c) for c in columns]))
    headed = df.withColumn("_head", F.substring(digest, 1, HEAD))
    return headed.withColumn("_order", F.concat(F.col("_head"), whole_row))


def exact_text(df, name):
    """A text that differs wherever values differ; JSON, say, has no microseconds."""
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, (T.BinaryType, T.StringType)):
        text = F.concat(F.lit("="), F.hex(c.cast("binary")))
    elif isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        text = F.concat(F.lit("="), F.to_json(F.struct(c), {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX"}))
    else:
        text = F.concat(F.lit("="), c.cast("string"))
    return F.coalesce(text, F.lit("-"))


def class_counts(df, target):
    """Rows per class in class order, or None for more than ``CLASS_LIMIT`` classes, which stay a table."""
    found = df.groupBy(F.col(target)).agg(F.count(F.lit(1)).alias("n")).limit(CLASS_LIMIT + 1).collect()
    if len(found) > CLASS_LIMIT:
        return None
    return dict(sorted(((r[0], r["n"]) for r in found), key=lambda e: (e[0] is not None, e[0])))


def mark_test(df, target, test_size=0.2, seed=42, key=None, unique_key=False, name="is_test",
              sort_limit=SORT_LIMIT, counts=None):
    """All rows with a flag ``name``: true for the test rows.

    ``key`` orders the rows, all columns when left out. Say ``unique_key`` when no two rows share a
    key; otherwise the whole row takes part in the order, and copies of one row are split by number.
    ``counts`` are the class counts, where they are known already.
    """
    counts = class_counts(df, target) if counts is None else counts
    if counts is None:
        return mark_many(df, target, test_size, seed, key, unique_key, name, sort_limit)
    found = find_cuts(df, target, test_size, seed, key, unique_key, sort_limit, counts)
    return apply_cuts(df, found, name)


def apply_cuts(df, found, name):
    if not found.partial:
        return found.flag(df, name)
    marked = found.joined(df)
    at_cut = F.col("_head") == F.substring("_cut", 1, HEAD)
    tied = F.coalesce((F.col("_keep") < F.col("_copies")) & at_cut & (F.col("_order") == F.col("_cut")), F.lit(False))
    whole = marked.where(~tied).select(*df.columns, _before_cut().alias(name))
    return whole.unionByName(_divide_copies(marked.where(tied), df.columns, name))


def quota_table(df, target, test_size):
    """(class, n, k) as ``quotas`` has them, for any number of classes: rests are ranked range by range."""
    counts = written(df.groupBy(F.col(target).alias("_class")).agg(F.count(F.lit(1)).alias("_n")), "split-classes")
    total = counts.agg(F.sum("_n")).first()[0]
    wanted = min(total, math.ceil(test_size * total))
    share = F.lit(wanted).cast("decimal(19,0)") * F.col("_n")
    based = counts.withColumns({"_base": F.floor(share / total).cast("long"), "_rest": (share % total).cast("decimal(38,0)")})
    # Rounding of the division is put right by the rest, which is exact.
    based = based.withColumn("_base", ((share - F.col("_rest")) / total).cast("long")).withColumn("_one", F.lit(1))
    more = wanted - based.agg(F.sum("_base")).first()[0]
    placed = row_number_by_range(based, ["_one"], [F.col("_rest").desc(), F.col("_class").asc_nulls_first()], "_place")
    return written(placed.select("_class", "_n", (F.col("_base") + (F.col("_place") <= more).cast("long")).alias("_k")),
                   "split-quotas")


def written(df, name):
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mark_many(df, target, test_size, seed, key, unique_key, name, sort_limit):
    """``mark_test`` where classes are too many for the driver.

    Classes of at most ``sort_limit`` rows are numbered in their order, each in one task; the few larger
    ones, of which there are at most rows / ``sort_limit``, are cut as ``mark_test`` does it.
    """
    table = quota_table(df, target, test_size)
    columns = df.columns
    same = F.col(target).eqNullSafe(F.col("_class"))
    ordered = with_order(df, list(key or columns), seed, unique_key, columns).join(
        table.where(F.col("_n") <= sort_limit), same)
    place = F.row_number().over(Window.partitionBy("_class").orderBy("_order"))
    small = ordered.withColumn("_place", place).select(*columns, (F.col("_place") <= F.col("_k")).alias(name))
    large = {r["_class"]: (r["_n"], r["_k"]) for r in table.where(F.col("_n") > sort_limit).collect()}
    if not large:
        return small
    rows = df.join(table.where(F.col("_n") > sort_limit).select("_class"), same, "left_semi")
    order = (list(key or columns), seed, unique_key)
    slim = with_order(rows, *order, columns).select(target, "_head", "_order")
    found = Cuts(target, _cuts(slim, target, {c: n for c, (n, _) in large.items()}, {c: k for c, (_, k) in large.items()},
                               sort_limit), order)
    return small.unionByName(apply_cuts(rows, found, name))


class Cuts:
    """Where the test rows of each class end in the order of the rows."""

    def __init__(self, target, rows, order):
        self.target, self.rows, self.order = target, rows, order
        self.partial = any(keep < copies for _, _, keep, copies in rows)

    def joined(self, df):
        near = _near(df, self.target, self.rows, "_class, _cut, _keep, _copies", "left")
        return with_order(near, *self.order, df.columns)

    def flag(self, df, name):
        """One projection beside a join with one row per class."""
        return self.joined(df).select(*df.columns, _before_cut().alias(name))


def _before_cut():
    """The head decides nearly all rows; only those at the cut need the whole order text."""
    cut = F.substring("_cut", 1, HEAD)
    head = F.substring("_head", 1, HEAD)
    decided = F.when(head < cut, True).when(head > cut, False).otherwise(F.col("_order") <= F.col("_cut"))
    return F.coalesce(decided, F.lit(False))


def find_cuts(df, target, test_size, seed, key=None, unique_key=False, sort_limit=SORT_LIMIT, counts=None):
    order = (list(key or df.columns), seed, unique_key)
    counts = class_counts(df, target) if counts is None else counts
    if not counts:
        return Cuts(target, [], order)
    rows = with_order(df, *order, df.columns).select(target, "_head", "_order")
    return Cuts(target, _cuts(rows, target, counts, quotas(counts, test_size), sort_limit), order)


def train_test(df, target, test_size=0.2, seed=42, key=None, unique_key=False):
    marked = mark_test(df, target, test_size, seed, key, unique_key, "_is_test")
    return marked.where("not _is_test").drop("_is_test"), marked.where("_is_test").drop("_is_test")


def mark_parts(df, target, test_size=0.2, seed=42, key=None, unique_key=False, name="part"):
    """All rows marked ``train``, ``validation`` or ``test``, and the class counts of each part (None for
    more than ``CLASS_LIMIT`` classes).

    The validation rows are the same share of what the test rows leave; all counts follow from the
    first ones and the quotas.
    """
    counts = class_counts(df, target)
    if counts is None:
        return parts_of_many(df, target, test_size, seed, key, unique_key, name)
    tests = quotas(counts, test_size)
    rest = {c: n - tests[c] for c, n in counts.items()}
    checks = quotas(rest, test_size)
    key = list(key or df.columns)
    salt = f"{seed}-validation"
    marked = mark_test(df, target, test_size, seed, key, unique_key, "_is_test", counts=counts)
    others = marked.where("not _is_test").select(*df.columns)
    cuts = find_cuts(others, target, test_size, salt, key, unique_key, counts=rest)
    part = F.when(F.col("_is_test"), "test").when(F.col("_is_check"), "validation").otherwise("train")
    if not cuts.partial:
        both = cuts.flag(marked, "_is_check")
    else:
        both = mark_test(others, target, test_size, salt, key, unique_key, "_is_check", counts=rest).unionByName(
            marked.where("_is_test"), allowMissingColumns=True
        )
    parts = both.select(*df.columns, part.alias(name))
    sizes = {
        "train": {c: rest[c] - checks[c] for c in counts}, "validation": checks, "test": tests,
    }
    return parts, sizes


def parts_of_many(df, target, test_size, seed, key, unique_key, name):
    columns = df.columns
    tested = written(mark_test(df, target, test_size, seed, key, unique_key, "_is_test"), "split-tested")
    rest = tested.where("not _is_test").select(*columns)
    checked = mark_test(rest, target, test_size, f"{seed}-validation", key, unique_key, "_is_check")
    parts = checked.select(*columns, F.when(F.col("_is_check"), "validation").otherwise("train").alias(name)).unionByName(
        tested.where("_is_test").select(*columns, F.lit("test").alias(name)))
    return parts, None


def _near(rows, target, table, names, how="inner"):
    """Join a table of one row per class, whose size CLASS_LIMIT bounds."""
    kind = rows.schema[target].dataType.simpleString()
    types = {"_class": kind, "_rest": "long", "_keep": "long", "_copies": "long"}
    ddl = ", ".join(f"{n.strip()} {types.get(n.strip(), 'string')}" for n in names.split(","))
    side = F.broadcast(small_table(rows.sparkSession, table, ddl))
    return rows.join(side, F.col(target).eqNullSafe(F.col("_class")), how)


def _cuts(slim, target, counts, wanted, sort_limit):
    """(class, cut, keep, copies): the k-th order text, its rows, and how many of them to keep.

    Four steps of three digits tell more order texts apart than there can be rows, so what is still
    large after them, or does not shrink in one of them, are copies, which the last count gathers.
    """
    bounds = [(c, "", k) for c, k in wanted.items() if k > 0]
    size, depth = max(counts.values()), 0
    while bounds and size > sort_limit and depth < 4 * DIGITS:
        depth += DIGITS
        before = size
        text = "_head" if depth <= HEAD else "_order"
        bounds, size = _step(slim, target, bounds, text, depth)
        if 2 * size > before:
            if depth > HEAD:
                break
            depth = HEAD
    found = []
    if bounds:
        hits = _hits(slim, target, bounds, "_order", F.col("_order"))
        found = [(r[target], r["_cell"], r["_rest"] - r["_before"], r["_n"]) for r in hits]
    none = [(c, "", 0, 0) for c, k in wanted.items() if k == 0]
    return found + none


def _step(slim, target, bounds, text, depth):
    hits = _hits(slim, target, bounds, text, F.substring(text, 1, depth))
    return [(r[target], r["_cell"], r["_rest"] - r["_before"]) for r in hits], max(r["_n"] for r in hits)


def _hits(slim, target, bounds, text, cell):
    """Per class the cell in which its quota falls."""
    near = _near(slim, target, bounds, "_class, _prefix, _rest")
    head = F.substring("_prefix", 1, HEAD)
    inside = near.where(F.col("_head").startswith(head) & F.col(text).startswith(F.col("_prefix")))
    cells = inside.groupBy(target, "_rest", cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(target).orderBy("_cell"))
    placed = cells.withColumn("_before", upto - F.col("_n"))
    return placed.where("_before < _rest and _rest <= _before + _n").collect()


def _divide_copies(tied, columns, name):
    """Copies of one row: count them, keep the wanted number as test rows, the others as train rows."""
    counted = tied.groupBy(*columns, "_keep").agg(F.count(F.lit(1)).alias("_n"))
    parts = F.explode(
        F.array(
            F.struct(F.lit(True).alias(name), F.col("_keep").alias("_m")),
            F.struct(F.lit(False).alias(name), (F.col("_n") - F.col("_keep")).alias("_m")),
        )
    )
    sized = counted.select(*columns, parts.alias("_p")).select(*columns, "_p.*").where("_m > 0")
    chunks = sized.withColumn("_chunk", F.explode(F.expr(f"sequence(0L, (_m - 1) div {COPY_CHUNK})")))
    last = F.least(F.lit(COPY_CHUNK), F.col("_m") - F.col("_chunk") * COPY_CHUNK)
    copies = chunks.repartition("_chunk").withColumn("_i", F.explode(F.sequence(F.lit(1), last)))
    return copies.select(*columns, name)
