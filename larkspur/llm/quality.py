"""Line-first cleaning and document quality, as column expressions.

Every line is judged by punctuation, navigation and boilerplate rules. Lines that fail are removed; a
document that loses too much of its text, or that fails the counts over the whole text, is rejected.

A word is a run of characters other than space and \\t \\n \\v \\f \\r. Null text counts as empty: no words,
rejected for being short. Only the text is read, so other columns may have any name. Every input row gives
one output row; repeated rows give repeated results. Nothing is shuffled.
"""

import functools

from pyspark.sql import Column, functions as F

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A document is rejected if it loses a larger part of its word characters than this.
MAX_LOST = 0.3
SYMBOLS = "#*$%&|<>"
#: A line of at least so many words has to end a sentence.
SENTENCE_WORDS = 3
#: Symbols a word and shouting words a word beyond which, and separators a word from which on, a line is no prose.
MAX_SYMBOL_RATE, MAX_SEPARATOR_RATE, MAX_SHOUT_RATE = 0.5, 0.3, 0.5
ENDS = ".!?…。！？:;\"'”’»)]"
INNER_END = r"[.!?…] "
#: Sentence ends of further scripts, which `sentences` takes beside ENDS.
SCRIPT_ENDS = "।॥؟۔።፧፨။៕។།։"
ANY_END = r"[" + ENDS.replace("]", r"\]") + SCRIPT_ENDS + r"]\s*+$|[.!?…" + SCRIPT_ENDS + r"]\s"
#: Line breaks inside a paragraph: the next line goes on in small letters or a script without capitals, or with any
#: letter after a line of a usual width.
#: The break comes before the look behind it, so that only breaks are looked at.
INSIDE = r"\n(?<=\S[ \t\r]{0,2}\n)(?=[\p{Ll}\p{Lo}])|\n(?<=[^\n]{45}\n)(?=\p{L})"
SEPARATORS = ("|", "›", "»", "•", ">", "·", "::")
NAVIGATION = (
    r"(?i)^\W*(home|menu|next|previous|prev|back|log ?in|log ?out|sign (in|up)|register|search|share|print|"
    r"contact( us)?|about( us)?|site ?map|skip to (main )?content|read more|click here|top|tags?|categor(y|ies)|"
    r"comments?|subscribe|newsletter|follow us)\W*$"
)
BOILERPLATE = (
    "we use cookies", "cookie policy", "privacy policy", "terms of use", "terms of service", "enable javascript",
    "javascript is disabled", "all rights reserved", "lorem ipsum", "powered by", "back to top", "add to cart",
    "subscribe to our newsletter", "page not found", "access denied",
)


def blank_free(text: Column) -> Column:
    """The text with every white-space character of a word break as a space."""
    for c in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(blank_free(text), " "), "")


def without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def holds_any(text: Column, parts) -> Column:
    return functools.reduce(lambda a, b: a | b, [F.contains(text, F.lit(x)) for x in parts])


def symbols_in(text: Column) -> Column:
    return F.length(text) - F.length(without(text, SYMBOLS))


def bare(text: Column) -> Column:
    return without(text, " \t\n\x0b\x0c\r")


def let(value: Column, use) -> Column:
    """``use(value)``, with the value worked out once: inside ``use`` it is a variable. A column that is
    used inside a lambda may else be worked out anew for every element."""
    return F.transform(F.array(value), use)[0]


def window_hashes(words: Column) -> Column:
    """A 64-bit hash of each window of three words, by place."""
    return F.transform(F.sequence(F.lit(0), F.size(words) - 3),
                       lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))


def covered_words(hashes: Column) -> Column:
    """Words inside a window whose hash occurs twice."""
    def count(ordered):
        n = F.size(ordered) - 1
        places = F.flatten(F.zip_with(
            F.slice(ordered, F.lit(1), n), F.slice(ordered, F.lit(2), n),
            lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))
            .otherwise(F.array().cast("array<int>"))))
        return F.size(F.array_distinct(F.flatten(F.transform(
            F.array_distinct(places), lambda i: F.array(i, i + 1, i + 2)))))

    return let(F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), count)


def repeated_words(words: Column) -> Column:
    """Words inside a window of three words that is found twice or more, its first place included. Only
    texts in which a window occurs twice are sorted."""
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(
        window_hashes(words),
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered_words(h)),
    )).cast("long")


def n_words(text: Column) -> Column:
    return F.size(words_of(text))


def ends_sentence(line: Column) -> Column:
    """Whether a line ends a sentence, or holds the end of one."""
    last = F.substr(F.rtrim(line), F.lit(-1))
    return F.instr(F.lit(ENDS), last).cast("boolean") | line.rlike(INNER_END)


def sentences(text: Column) -> Column:
    """Whether each line ends or holds the end of a sentence, in any script, or is followed by one that does in the
    same paragraph."""
    marked = F.regexp_replace(F.replace(text, F.lit("\x01"), F.lit(" ")), INSIDE, "\x01")

    def upto_last(ends):
        last = F.size(ends) - F.array_position(F.reverse(ends), True)
        return F.when(F.array_contains(ends, True), F.transform(ends, lambda _, i: i <= last)).otherwise(ends)

    return F.flatten(F.transform(F.split(marked, "\n", -1), lambda paragraph: let(
        F.transform(F.split(paragraph, "\x01", -1), lambda line: line.rlike(ANY_END)), upto_last)))


def line_rule(x: Column, doc: Column) -> Column:
    """The rule that a line with its number of words fails, or null. Lines without a word pass.

    ``doc`` has, for each costly test, whether any line of the document can fail it.
    """
    line, n = x["line"], x["n"]
    separators = F.size(F.filter(F.split(line, " "), lambda w: w.isin(*SEPARATORS)))
    shouting = F.length(line) - F.length(F.replace(line, F.lit("!!"), F.lit("!")))
    return (
        F.when(n == 0, F.lit(None).cast("string"))
        .when(doc["separators"] & (F.when(doc["separators"], separators) >= MAX_SEPARATOR_RATE * n),
              F.lit("navigation"))
        .when((n <= 4) & line.rlike(NAVIGATION), F.lit("navigation"))
        .when(doc["symbols"] & (F.when(doc["symbols"], symbols_in(line)) > MAX_SYMBOL_RATE * n),
              F.lit("boilerplate"))
        .when(doc["shouts"] & (F.when(doc["shouts"], shouting) > MAX_SHOUT_RATE * n), F.lit("boilerplate"))
        .when(doc["phrases"] & holds_any(F.lower(line), BOILERPLATE), F.lit("boilerplate"))
        .when((n >= SENTENCE_WORDS) & ~x["ends"], F.lit("punctuation"))
    )


def failing(rules: Column, rule: str) -> Column:
    return F.size(F.filter(rules, lambda x: x == rule)).cast("long").alias(f"lost_{rule}")


def measures(text: Column, wrapped=False) -> Column:
    """A struct of the counts of a text, the lines lost to each rule and what is left of it. ``wrapped`` judges the end
    of a line with its paragraph (``sentences``), else each line is judged alone, as in SQL."""
    split = F.split(text, "\n", -1)
    if wrapped:
        lines = F.zip_with(split, sentences(text), lambda x, e: F.struct(x.alias("line"), n_words(x).alias("n"), e.alias("ends")))
    else:
        lines = F.transform(split, lambda x: F.struct(x.alias("line"), n_words(x).alias("n"), ends_sentence(x).alias("ends")))

    def doc(symbols):
        return F.struct(
            (symbols > 0).alias("symbols"), holds_any(text, SEPARATORS).alias("separators"),
            F.contains(text, F.lit("!!")).alias("shouts"),
            let(F.lower(text), lambda x: holds_any(x, BOILERPLATE)).alias("phrases"))

    def by_words(w):
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"))

    def left(lines, rules):
        return F.array_join(F.filter(F.zip_with(
            lines, rules, lambda x, r: F.when(r.isNull(), x["line"])), lambda x: x.isNotNull()), "\n")

    def by_rules(lines, rules):
        return F.struct(
            *[failing(rules, r) for r in ("punctuation", "navigation", "boilerplate")],
            F.when(F.size(F.array_compact(rules)) > 0, left(lines, rules)).alias("left"))

    def by_lines(x, symbols):
        full = F.transform(F.filter(x, lambda y: y["n"] > 0), lambda y: y["line"])
        return F.struct(
            let(full, lambda y: (F.size(y) - F.size(F.array_distinct(y))).cast("long")).alias("n_dup_lines"),
            let(let(doc(symbols), lambda d: F.transform(x, lambda y: line_rule(y, d))), lambda r: by_rules(x, r)).alias("by"))

    return F.struct(
        let(words_of(text), by_words).alias("words"),
        let(symbols_in(text).cast("long"), lambda n: F.struct(
            n.alias("n_symbols"), let(lines, lambda x: by_lines(x, n)).alias("lines"))).alias("rest"))


def clean(docs, text="text", keep=("doc_id",), max_lost=MAX_LOST, min_words=MIN_WORDS):
    """The columns ``keep`` of each document, its counts, the lines lost to each rule, its cleaned text and
    whether it is kept. The columns of ``docs`` that aren't named are not read."""
    t = F.coalesce(F.col(text), F.lit(""))
    out = docs.select(*[F.col(c) for c in keep], t.alias("_t"), let(t, lambda x: measures(x)).alias("_m"))
    lines = [f"_m.rest.lines.by.lost_{r}" for r in ("punctuation", "navigation", "boilerplate")]
    out = out.select(*keep, "_m.words.n_words", "_m.words.word_chars", "_m.rest.n_symbols",
                     "_m.rest.lines.n_dup_lines", "_m.words.n_repeat_words", *lines,
                     F.coalesce("_m.rest.lines.by.left", "_t").alias("clean_text"),
                     F.when(F.col("_m.rest.lines.by.left").isNull(), F.lit(0).cast("long")).otherwise(
                         F.col("_m.words.word_chars") - F.length(bare(F.col("_m.rest.lines.by.left"))))
                     .alias("lost_chars"))
    out = out.withColumn(
        "base_failed", (F.col("n_words") < min_words)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    return out.withColumn(
        "kept", ~F.col("base_failed") & (F.col("lost_chars") <= max_lost * F.col("word_chars")))


def kept_docs(docs, text="text"):
    """The rows of ``docs`` that are kept, their failing lines removed; all columns stay, whatever their names. Lines
    inside a wrapped paragraph and sentence ends of all scripts count as prose."""
    # Exploding one value keeps the filter behind it, so that the measures are worked out once.
    out = docs.withColumn("_quality_", F.explode(F.array(F.struct(let(
        F.coalesce(F.col(text), F.lit("")), lambda t: measures(t, wrapped=True)).alias("m")))))
    m = "_quality_.m"
    left = F.col(f"{m}.rest.lines.by.left")
    words, n, repeated = (F.col(f"{m}.words.{c}") for c in ("word_chars", "n_words", "n_repeat_words"))
    lost = F.when(left.isNull(), F.lit(0)).otherwise(words - F.length(bare(left)))
    out = out.where((n >= MIN_WORDS) & (100 * repeated <= MAX_REPEAT_PERCENT * n) & (lost <= MAX_LOST * words))
    return out.withColumn(text, F.coalesce(left, F.col(text))).drop("_quality_")


def op1_quality_rules(spark, sf_dir):
    """Counts and verdict of every document."""
    out = clean(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "lost_punctuation", "lost_navigation", "lost_boilerplate",
                      "lost_chars")
