"""Personal data in text: fixed patterns, and further spans chosen by boosted trees.

``email``, ``ip``, ``card`` and ``phone`` follow fixed patterns and checks and always count. Beyond these, generators
with high recall propose spans that may overlap (addresses spelled out, numbers without a country code, identity and account
numbers, keys). Boosted trees, fitted on formats and contexts, score each one, and those above their kind's
threshold are added where they don't touch a span of a fixed pattern; of overlapping ones the best stays.

Everything is column expressions: patterns, places, features, and the trees themselves as nested
conditions, so nothing is shuffled. Places count code points, ends are exclusive. Null text is empty and has
no spans. Only the text is read besides the columns asked for. Every input row gives one output row.
"""

import functools
import random

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, functions as F

from larkspur.llm.quality import holds_any, let
from larkspur.session import small_table

#: Possessive forms of the contract's patterns: a run that can't match is tried once, at its start.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
KINDS = ("email", "ip", "card", "phone")
#: What generators propose. Each is tried only in texts that hold one of the strings beside it.
GENERATORS = {
    "mail_spelled": (
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\s?(?:\(at\)|\[at\]|@| at )\s?[A-Za-z0-9-]++"
        r"(?:\s?(?:\(dot\)|\[dot\]| dot )\s?[A-Za-z0-9-]++)++", (" dot ", "dot)", "dot]")),
    "number_local": (r"(?<![0-9+.-])\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,5}(?![0-9])", None),
    "identity": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", ("-",)),
    "account": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", None),
    "secret": (r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]{0,40}[0-9])[A-Za-z0-9_+/-]{20,}+=*+", None),
}
ORDER = (*KINDS, *GENERATORS)
CONTEXT = 24
WORDS = {
    "contact": "(?i)(phone|tel|call|fax|mobile|contact|mail|write|reach)",
    "secret": "(?i)(token|key|secret|passw|auth|bearer|credential)",
    "identity": "(?i)(ssn|social|iban|account|passport|licen[cs]e no|tax)",
    "other": "(?i)(version|chapter|page|figure|isbn|doi|order|invoice|item|room|year|sha|md5|commit|http)",
}
#: Texts per kind and label that the trees are fitted on, and the precision their thresholds aim at.
EXAMPLES, PRECISION = 160, 0.95
CHUNK = 256


def places(gaps: Column, found: Column, kind: str) -> Column:
    """Spans from the texts between matches and the matches: sums over chunks, then inside each chunk, so
    that a text with very many matches costs little more for each."""
    sizes = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.struct(
        F.length(g).alias("g"), F.length(m).alias("m"), m.alias("t")))

    def chunked(s):
        n = F.ceil(F.size(s) / CHUNK).cast("int")
        parts = F.transform(F.sequence(F.lit(0), n - 1), lambda c: F.slice(s, c * CHUNK + 1, F.lit(CHUNK)))
        totals = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda a, x: a + x["g"] + x["m"]))
        return let(parts, lambda ps: let(running(totals), lambda before: F.flatten(F.zip_with(ps, before, inside))))

    def running(totals):
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(totals, start, lambda a, x: F.struct(
            (a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])

    def inside(part, before):
        start = F.struct(before.alias("at"), F.array().cast(SPANS).alias("out"))
        return F.aggregate(part, start, lambda a, x: F.struct(
            (a["at"] + x["g"] + x["m"]).alias("at"),
            F.concat(a["out"], F.array(span(kind, a["at"] + x["g"], a["at"] + x["g"] + x["m"], x["t"]))).alias("out")),
            lambda a: a["out"])

    return let(sizes, chunked)


SPANS = "array<struct<start:int,end:int,kind:string,text:string>>"


def span(kind, start, end, text):
    return F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), text.alias("text"))


def found(text: Column, kind: str, pattern: str, may: Column) -> Column:
    """All matches of a pattern as spans, leftmost and not overlapping."""
    matches = let(F.struct(F.split(text, pattern, -1).alias("gaps"),
                           F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")),
                  lambda x: places(x["gaps"], x["found"], kind))
    return F.when(may & text.rlike(pattern), matches).otherwise(F.array().cast(SPANS))


def luhn(digits: Column) -> Column:
    def add(total, i):
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def passes(kind: str, text: Column) -> Column:
    if kind == "ip":
        return text.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits_of(text)).between(12, 19), let(digits_of(text), luhn)).otherwise(False)
    if kind == "phone":
        return F.length(digits_of(text)).between(9, 15)
    return F.lit(True)


def base(text: Column, digit: Column) -> dict[str, Column]:
    may = {"email": F.contains(text, F.lit("@")), "ip": digit & F.contains(text, F.lit(".")), "card": digit,
           "phone": digit & F.contains(text, F.lit("+"))}
    patterns = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE)))

    def checked(kind):
        return F.filter(found(text, kind, patterns[kind], may[kind]), lambda s: passes(kind, s["text"]))

    return {k: checked(k) for k in KINDS}


def features(kind: Column, text: Column, before: Column) -> dict[str, Column]:
    n = F.length(text)
    out = {
        "length": n, "digits": F.length(digits_of(text)), "upper": F.length(F.regexp_replace(text, "[^A-Z]", "")),
        "lower": F.length(F.regexp_replace(text, "[^a-z]", "")),
        "other": F.length(F.regexp_replace(text, "[A-Za-z0-9]", "")),
        "distinct": F.size(F.array_distinct(F.split(text, ""))),
        "changes": F.size(F.split(text, "(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])")),
        "quoted": before.rlike("[\"'=:]\\s*$").cast("int"),
    }
    out |= {f"near_{k}": before.rlike(p).cast("int") for k, p in WORDS.items()}
    out |= {f"is_{k}": (kind == k).cast("int") for k in GENERATORS}
    return {k: v.cast("double") for k, v in out.items()}


def examples(seed=11, each=EXAMPLES):
    """(kind, text, before, label): formats with and without the contexts that go with them."""
    r = random.Random(seed)

    def digits(n):
        return "".join(r.choice("0123456789") for _ in range(n))

    def word(low=3, high=9):
        return "".join(r.choice("abcdefghilmnoprstuv") for _ in range(r.randint(low, high)))

    def token(n, chars="0123456789abcdef"):
        return "".join(r.choice(chars) for _ in range(n))

    def make(kind, yes):
        if kind == "mail_spelled":
            at, dot = r.choice([("(at)", "(dot)"), ("[at]", "[dot]"), (" at ", " dot ")])
            if yes:
                return f"{word()}{r.choice(['', '.' + word(), digits(2)])}{at}{word()}{dot}{r.choice(['com', 'org', 'net', 'de'])}"
            return f"{word()} at {word()} dot {word(7, 12)}"
        if kind == "number_local":
            if yes:
                return f"({digits(3)}) {digits(3)}-{digits(4)}" if r.random() < 0.5 else f"{digits(3)}-{digits(3)}-{digits(4)}"
            return f"{digits(2)} {digits(3)} {digits(3)}" if r.random() < 0.5 else f"{digits(4)}.{digits(3)}.{digits(3)}"
        if kind == "identity":
            return f"{digits(3)}-{digits(2)}-{digits(4)}"
        if kind == "account":
            return r.choice(["DE", "FR", "ES", "GB"]) + digits(2) + (digits(18) if yes else token(12, "ABCDEFGHIJKLMNOP"))
        return token(r.choice([32, 40, 48])) if yes else f"{word(12, 16)}-{word(8, 12)}{digits(1)}"

    near = {
        "mail_spelled": "write me at: ", "number_local": "phone ", "identity": "ssn ", "account": "iban ", "secret": 'token = "',
    }
    rows = []
    for kind in GENERATORS:
        for yes in (1, 0):
            for _ in range(each):
                context = near[kind] if yes and r.random() < 0.8 else r.choice(
                    [word() + " ", word() + ", ", "order ", "version ", "page "] if not yes else [word() + " ", word() + ": "])
                rows.append((kind, make(kind, yes), word() + " " + context, yes))
    r.shuffle(rows)
    return rows


def as_columns(tree, names):
    """A fitted regression tree as a function from named columns to a column."""
    def node(x):
        if x.subtreeDepth() == 0:
            value = float(x.prediction())
            return lambda f: F.lit(value)
        at, cut = names[x.split().featureIndex()], float(x.split().threshold())
        left, right = node(x.leftChild()), node(x.rightChild())
        return lambda f: F.when(f[at] <= cut, left(f)).otherwise(right(f))

    return node(tree._call_java("rootNode"))


@functools.lru_cache(maxsize=4)
def fitted(spark):
    """A function from named features to the score of a span, and each kind's threshold.

    Trees are fitted on three quarters of the examples; a threshold is the smallest score from which, among
    the held-out examples of the kind, at least ``PRECISION`` are personal data. The examples are a fixed small number.
    """
    rows = small_table(spark, [(*x, i) for i, x in enumerate(examples())],
                       "kind string, text string, before string, label int, i int")
    named = features(F.col("kind"), F.col("text"), F.col("before"))
    data = rows.select("i", "kind", F.col("label").cast("double").alias("label"), *[c.alias(k) for k, c in named.items()])
    data = VectorAssembler(inputCols=list(named), outputCol="features").transform(data).coalesce(1).cache()
    model = GBTClassifier(maxIter=8, maxDepth=3, stepSize=0.3, seed=5).fit(data.where("i % 4 != 0"))
    trees = [(w, as_columns(t, list(named))) for w, t in zip(model.treeWeights, model.trees)]

    def score(f):
        return functools.reduce(lambda a, b: a + b, [w * t(f) for w, t in trees])

    held = data.where("i % 4 = 0").select("kind", "label", score({k: F.col(k) for k in named}).alias("s")).collect()
    data.unpersist()
    thresholds = {}
    for kind in GENERATORS:
        ranked = sorted(((r["s"], r["label"]) for r in held if r["kind"] == kind), reverse=True)
        hits, best = 0.0, float("inf")
        for n, (s, label) in enumerate(ranked, 1):
            hits += label
            if hits / n >= PRECISION and (n == len(ranked) or ranked[n][0] < s):
                best = s
        thresholds[kind] = best
    return score, thresholds


def overlaps(a, b):
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def proposed(text: Column, digit: Column, model) -> Column:
    """Spans of the generators that pass their thresholds, with scores, by place."""
    score, thresholds = model
    all_ = []
    for kind, (pattern, needs) in GENERATORS.items():
        may = holds_any(text, needs) if needs else F.lit(True)
        all_.append(found(text, kind, pattern, may if kind == "mail_spelled" else may & digit))

    def scored(s):
        before = F.substring(text, F.greatest(s["start"] - CONTEXT + 1, F.lit(1)), F.least(s["start"], F.lit(CONTEXT)))
        return let(before, lambda b: let(F.struct(*[c.alias(k) for k, c in features(s["kind"], s["text"], b).items()]),
                   lambda f: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), score(f).alias("score"))))

    return F.array_sort(F.filter(F.transform(F.concat(*all_), scored), lambda s: functools.reduce(
        lambda a, b: a | b, [(s["kind"] == k) & (s["score"] >= t) for k, t in thresholds.items() if t != float("inf")]
        or [F.lit(False)])))


CHOSEN = "array<struct<start:int,end:int,kind:string,score:double>>"


def chosen(spans: Column) -> Column:
    """Of overlapping spans, taken in order of place, the one with the larger score."""
    def take(a, s):
        last = a["last"]
        clash = last.isNotNull() & overlaps(last, s)
        return F.struct(F.when(clash & (last["score"] >= s["score"]), last).otherwise(s).alias("last"),
                        F.when(clash | last.isNull(), a["out"]).otherwise(F.concat(a["out"], F.array(last))).alias("out"))

    start = F.struct(F.lit(None).cast(CHOSEN.removeprefix("array<")[:-1]).alias("last"), F.array().cast(CHOSEN).alias("out"))
    return F.aggregate(spans, start, take, lambda a: F.concat(
        a["out"], F.when(a["last"].isNull(), F.array().cast(CHOSEN)).otherwise(F.array(a["last"]))))


def listed(spans: Column) -> Column:
    """kind:start:end of spans, by start and then by kind as listed."""
    rank = F.array(*[F.lit(k) for k in ORDER])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(rank, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def plain(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))


def spans_in(text: Column, model) -> Column:
    """A struct of the spans of each fixed pattern and the added ones."""
    def all_of(digit):
        return let(F.struct(*[plain(c).alias(k) for k, c in base(text, digit).items()]), lambda b: F.struct(
            *[b[k].alias(k) for k in KINDS],
            let(F.concat(*[b[k] for k in KINDS]), lambda fixed: plain(chosen(F.filter(
                proposed(text, digit, model), lambda s: ~F.exists(fixed, lambda x: overlaps(x, s)))))).alias("added")))

    return let(text.rlike("[0-9]"), all_of)


def scan(docs, text="text", keep=("doc_id",)):
    """The columns ``keep`` and the struct ``pii`` of spans (start, end, kind) for each fixed pattern and added."""
    model = fitted(docs.sparkSession)
    return docs.select(*keep, let(F.coalesce(F.col(text), F.lit("")), lambda t: spans_in(t, model)).alias("pii"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each stretch of spans replaced by the kind of its first one, as in [EMAIL]."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def cut(a, s):
        gap = F.substring(text, a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0)))
        label = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(
            s["start"] >= a["at"], F.concat(a["out"], F.array(gap, label))).otherwise(a["out"]).alias("out"))

    ordered = F.array_sort(spans)
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(ordered, start, cut, lambda a: F.concat(
        F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, F.length(text)))))


def redact(docs, text="text"):
    """``docs`` with the spans in ``text`` replaced; all columns stay. Null texts stay null."""
    model = fitted(docs.sparkSession)
    t = F.col(text)
    clean = let(t, lambda x: let(spans_in(x, model), lambda p: redacted(x, F.concat(*[p[k] for k in (*KINDS, "added")]))))
    return docs.withColumn(text, F.when(t.isNull(), t).otherwise(clean))


def op8_pii(spark, sf_dir):
    """Spans of personal data in every document."""
    p = F.col("pii")
    fixed = F.concat(*[p[k] for k in KINDS])
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", *[F.size(p[k]).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(fixed).cast("binary"), 256).alias("base_sha256"),
        listed(F.concat(fixed, p["added"])).alias("spans"))
