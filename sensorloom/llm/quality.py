"""Quality rules: a table of thresholds compiled into one projection of text ratios.

No user function runs: every metric is a Spark expression over the words and lines of the row
itself, so the operator is one narrow stage without a shuffle, whatever the size of the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh_names, let, text_of, words_of

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which "
    "one you were all her she there would their we him been has when who will no more if out so what up into than "
    "der die das und zu den von mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie "
    "nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch "
    "le la les de des et du un une en à que qui dans pour pas au sur ne se ce il sont plus par avec est son sa ou mais "
    "nous vous elle je tout y aux cette ont même "
    "el los las y del que en una con no por su para lo como más pero sus le ya o este sí porque esta entre cuando muy "
    "sin sobre también me hasta hay donde quien desde todo nos durante se al"
).split()

#: As written in prose, in titles and in capitals: cheaper than making each word of the corpus small.
STOP_FORMS = sorted({form for word in STOP_WORDS for form in (word, word.capitalize(), word.upper())})

WINDOW = 5  # words of a window whose repetition counts


@dataclass(frozen=True)
class Rule:
    """A row is kept if `low <= metric <= high`; an open side is None; null metrics pass."""

    metric: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0  # shorter texts pass: a ratio of few words says little


#: Production thresholds. They are wide: prose of any language with a space between words passes.
RULES = (
    Rule("n_words", low=10),
    Rule("mean_word_chars", low=1.5, high=25),
    Rule("symbols_per_word", high=0.3),
    Rule("marks_per_word", high=0.5),
    Rule("capital_ratio", high=0.6),
    Rule("stop_word_ratio", low=0.02, min_words=50),
    Rule("dup_line_ratio", high=0.5),
    Rule("repeat_word_ratio", high=0.2),
)


def _covered(starts: Column) -> Column:
    """Words that windows at these ascending starts cover."""
    return F.aggregate(
        F.transform(starts, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - x, F.lit(WINDOW)))),
        F.lit(0), lambda a, b: a + b)


def _repeated_starts(hashes: Column, repeated: Column) -> Column:
    """Places whose hash is in `repeated`: looked up in a short list, or found by one sort beside a long one."""
    def from_sorted(pairs: Column) -> Column:
        same = lambda s, j: F.coalesce(s["h"] == F.get(pairs, j)["h"], F.lit(False))
        hit = F.filter(pairs, lambda s, j: same(s, j - 1) | same(s, j + 1))
        return F.sort_array(F.transform(hit, lambda s: s["i"]))

    places = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    looked_up = F.transform(F.filter(places, lambda s: F.array_contains(repeated, s["h"])), lambda s: s["i"])
    return F.when(F.size(repeated) <= 16, looked_up).otherwise(let(F.sort_array(places), from_sorted))


def _covered_words(hashes: Column) -> Column:
    """Words inside windows whose hash occurs twice or more; windows start one word apart."""
    def more(ordered: Column) -> Column:
        repeated = F.array_distinct(F.filter(ordered, lambda h, i: F.coalesce(h == F.get(ordered, i - 1), F.lit(False))))
        return let(repeated, lambda r: let(_repeated_starts(hashes, r), _covered))

    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(F.sort_array(hashes), more))


def _window_hashes(w: Column) -> Column:
    """A hash for each window of five words, built from pairs, then fours, then the fifth word."""
    def joined(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))

    n = F.size(w)
    return let(joined(w, F.slice(w, 2, n)), lambda two: let(
        joined(two, F.slice(two, 3, n)), lambda four: F.slice(joined(four, F.slice(w, 5, n)), 1, n - (WINDOW - 1))))


def _repeat_words(words: Column) -> Column:
    return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(
        let(words, lambda w: let(_window_hashes(w), _covered_words)))


def _removed(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """All of `docs` plus its metrics.

    A null or empty text has no word: counts are 0 and ratios null. Repeated rows are measured
    alike. Columns of the same name as a metric are replaced.
    """
    own, words, kept = fresh_names(docs, "text", "words", "lines")
    base = docs.withColumn(own, text_of(text)).withColumn(words, words_of(F.col(own)))
    lines = F.filter(F.split(F.col(own), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = (base
               .withColumn("n_words", F.size(words).cast("long"))
               .withColumn("word_chars", F.length(F.array_join(words, "")).cast("long"))
               .withColumn("n_symbols", _removed(F.col(own), r"[#*$%&|<>]"))
               .withColumn("n_marks", _removed(F.col(own), r"[!?]"))
               .withColumn("n_capitals", _removed(F.col(own), r"[\p{Lu}]"))
               .withColumn(kept, lines)
               .withColumn("n_lines", F.size(kept).cast("long"))
               .withColumn("n_dup_lines", (F.size(kept) - F.size(F.array_distinct(kept))).cast("long"))
               .withColumn("n_stop_words", F.size(F.filter(words, lambda w: w.isin(STOP_FORMS))).cast("long"))
               .withColumn("n_repeat_words", _repeat_words(F.col(words)).cast("long")))
    per_word = lambda name: F.when(F.col("n_words") > 0, F.col(name) / F.col("n_words"))
    return (counted
            .withColumn("mean_word_chars", per_word("word_chars"))
            .withColumn("symbols_per_word", per_word("n_symbols"))
            .withColumn("marks_per_word", per_word("n_marks"))
            .withColumn("capital_ratio", F.when(F.col("word_chars") > 0, F.col("n_capitals") / F.col("word_chars")))
            .withColumn("stop_word_ratio", per_word("n_stop_words"))
            .withColumn("dup_line_ratio", F.when(F.col("n_lines") > 0, F.col("n_dup_lines") / F.col("n_lines")))
            .withColumn("repeat_word_ratio", per_word("n_repeat_words"))
            .drop(own, words, kept))


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """The table as one boolean expression; an empty table keeps every row."""
    keep = F.lit(True)
    for rule in rules:
        value = F.when(F.col("n_words") >= rule.min_words, F.col(rule.metric))
        if rule.low is not None:
            keep = keep & F.coalesce(value >= rule.low, F.lit(True))
        if rule.high is not None:
            keep = keep & F.coalesce(value <= rule.high, F.lit(True))
    return keep


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """`measure` plus `kept`."""
    return measure(docs, text).withColumn("kept", verdict(rules))
