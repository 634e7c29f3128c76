"""Personal data: fixed formats, and identifiers found by bootstrapping from their context.

1. One narrow pass finds the base kinds in every text and joins each span to one word, marked with its kind. Long words of mixed letters and
   digits, as keys and tokens are, are seeds too, though no spans by themselves.
2. Words have a lexical pattern: the two words before, or a name such as `password=`. Patterns are 64-bit hashes. All seeds
   are one end of a graph of patterns and instances; patterns before enough known instances are induced.
3. Most induced patterns are common words that happened to stand before a seed. The texts with seeds, a small part of all, already hold
   enough other words after those: what is unknown there is unknown everywhere, so a pattern that cannot reach `WITNESS` there cannot
   reach it at all in this round. Only the others are looked up in all texts, and every word after them is an instance, known or not.
4. The graph is scored: a pattern by the part of its instances that are known, an instance by the patterns it is seen with.
   Instances that become known are looked up in all texts, which induces further patterns; rounds end when none is new.
5. Patterns that are trusted in the end mark the words they stand before as further spans.

Only DataFrame functions run. Counts are combined before they are shuffled; edges meet scores in plain
sort-merge joins, which Spark splits where a pattern or a token holds much of the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh_names, let, stored, text_of

#: Fixed order of the base kinds.
KINDS = ("email", "ip", "card", "phone")

# The same matches as the plain formats, but linear: a match starts where its run of characters
# starts or where the match before ended, and runs are never taken back.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?:(?<![0-9])|\G)[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
BYTE = r"(?=[0-9])0*+(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])?"

MARKS = "\ue000\ue001\ue002\ue003"  # before a base span, one for each kind
GLUE, OTHER = "\ue004", "\ue005"       # a blank inside a span; what stands for these characters if a text holds them
HEAD = r"^(?:[\p{L}_-]++[=:])?[\"'(\[<]*"
TAIL = r"(?:[\"'][^\p{L}\p{N}]*|[.,;:!?\"')\]>]+)$"
ENDS = ".,;:!?\"')]>#$%&*|"  # last characters of words that may have a tail
SECRET = r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{20}"  # what a text with a key or token holds
TRUST = 0.75       # score from which a pattern marks tokens
SUPPORT = 3        # different known instances that a pattern needs
DOUBT = 1.0        # unknown instances that every pattern is credited with
WITNESS = 0.5      # score from which a pattern speaks for its instances; below, most of them are something else
BROADCAST = 200_000  # most patterns or instances that are broadcast; more are shuffled


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    n = F.length(digits)
    def add(total: Column, i: Column) -> Column:
        d = digits.substr(i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when((n - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _card(value: Column) -> Column:
    d = _digits(value)
    return F.length(d).between(12, 19) & let(d, luhn)


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind == "card":
        return _card(value)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def located(text: Column, pattern: str, use=lambda match, start, gap: F.struct(start.alias("start"), match.alias("match"))) -> Column:
    """`use(match, start, gap)` for all matches from left to right; gap is the text since the match before.

    The pieces between matches and the matches themselves add up to the places.
    """
    def placed(found: Column) -> Column:
        pieces = F.split(text, pattern, -1)
        def add(state: Column, i: Column) -> Column:
            start = state["at"] + F.length(F.get(state["gaps"], i))
            return F.struct((start + F.length(F.get(found, i))).alias("at"), F.concat(state["starts"], F.array(start)).alias("starts"),
                            state["gaps"].alias("gaps"))
        return let(pieces, lambda gaps: F.aggregate(
            F.sequence(F.lit(0), F.size(found) - 1),
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"), gaps.alias("gaps")), add,
            lambda state: F.transform(F.arrays_zip(found.alias("match"), state["starts"].alias("start"),
                                                   F.slice(gaps, 1, F.size(found)).alias("gap")),
                                      lambda z: use(z["match"], z["start"], z["gap"]))))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
               lambda found: F.when(F.size(found) > 0, placed(found)))


def base_spans(text: Column) -> Column:
    """Spans (start, order, end, kind) of the base kinds by start, then kind; code points, end exclusive."""
    every = []
    for order, (kind, pattern, sign) in enumerate(zip(KINDS, (EMAIL, IP, CARD, PHONE), ("@", ".", None, "+"), strict=True)):
        spans = located(text, pattern, lambda match, start, gap, order=order, kind=kind: F.struct(
            start.alias("start"), F.lit(order).alias("order"), (start + F.length(match)).alias("end"),
            F.lit(kind).alias("kind"), _valid(kind, match).alias("ok")))
        if sign:
            spans = F.when(F.contains(text, F.lit(sign)), spans)
        every.append(F.coalesce(F.filter(spans, lambda s: s["ok"]), F.array().cast(
            "array<struct<start:int,order:int,end:int,kind:string,ok:boolean>>")))
    return F.transform(F.sort_array(F.concat(*every)),
                       lambda s: F.struct(s["start"].alias("start"), s["order"].alias("order"), s["end"].alias("end"), s["kind"].alias("kind")))


def marked(text: Column, spans: Column) -> Column:
    """The text with a mark before each span and no blanks inside; of overlapping spans the first counts."""
    def add(state: Column, s: Column) -> Column:
        mark = F.substring(F.lit(MARKS), s["order"] + 1, F.lit(1))
        value = F.regexp_replace(text.substr(s["start"] + 1, s["end"] - s["start"]), r"\s", GLUE)
        return F.when(s["start"] < state["at"], state).otherwise(F.struct(
            s["end"].alias("at"), F.concat(state["out"], F.array(text.substr(state["at"] + 1, s["start"] - state["at"]), mark, value)).alias("out")))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, add, lambda state: F.concat(
        F.array_join(state["out"], ""), text.substr(state["at"] + 1, F.length(text))))).otherwise(text)


def scan(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per document: key, row (a fingerprint of key and text), base spans, marked text, whether it may hold a seed."""
    source = docs.select(F.col(key).alias("key"), F.xxhash64(F.col(key), F.col(text)).alias("row"), base_spans(text_of(text)).alias("base"),
                         F.translate(text_of(text), MARKS + GLUE, OTHER * 5).alias("plain"))
    return source.select("key", "row", "base", marked(F.col("plain"), F.col("base")).alias("marked"),
                         ((F.size("base") > 0) | F.col("plain").rlike(SECRET)).alias("seeded"))


def _parts(word: Column) -> tuple[Column, Column, Column]:
    """Head, value and name of a word."""
    # Most words have neither a head nor a tail; for those no pattern runs.
    named = F.contains(word, F.lit("=")) | F.contains(word, F.lit(":"))
    head = F.when(named | F.substring(word, 1, 1).isin(*"\"'([<"), F.regexp_extract(word, HEAD, 0)).otherwise("")
    rest = word.substr(F.length(head) + 1, F.length(word))
    value = F.when(F.substring(word, -1, 1).isin(*ENDS), F.regexp_replace(rest, TAIL, "")).otherwise(rest)
    name = F.when(named, F.lower(F.regexp_extract(head, r"[\p{L}_-]++[=:]", 0))).otherwise("")
    return head, value, name


def _secret(value: Column) -> Column:
    """Is the word long, and mixed of many different letters and digits?"""
    def some(of: str) -> Column:
        return F.length(F.regexp_replace(value, f"[^{of}]", "")) >= 4

    return ((F.length(value) >= 20) & value.rlike("^[A-Za-z0-9_+/-]{20,}=*$") & some("0-9") & some("A-Za-z")
            & (F.size(F.array_distinct(F.split(value, ""))) >= 10))


def _hashed(scanned: DataFrame) -> DataFrame:
    """One row per document: key, row, and for each word its pattern (null: none) and itself."""
    def split(text: Column) -> Column:
        return F.array_remove(F.split(text, r"\s+"), "")

    def pattern(near: Column):
        def of(word: Column, i: Column) -> Column:
            two = F.when(i > 0, F.xxhash64(F.get(near, i - 2), F.get(near, i - 1)))
            named = F.contains(word, F.lit("=")) | F.contains(word, F.lit(":"))
            return F.when(named, let(_parts(word)[2], lambda name: F.when(name != "", F.xxhash64(name, F.lit(1))).otherwise(two))).otherwise(two)
        return of

    near = split(F.translate(F.lower("marked"), "123456789", "000000000"))
    body = scanned.select("key", "row", split(F.col("marked")).alias("words"), near.alias("near"))
    # Words travel inside what is exploded: Spark would split a text again for every row that looks at its words.
    return body.select("key", "row", let(F.col("near"), lambda n: F.transform(
        "words", lambda w, i: F.struct(pattern(n)(w, i).alias("pattern"), w.alias("w")))).alias("words"))


def _spelt(places: DataFrame) -> DataFrame:
    """Places (key, row, i, pattern, w) with instance and kind (null: unknown).

    Words that hold a base span, but do not begin with it, are left out.
    """
    _, value, _ = _parts(F.col("w"))
    # Exploded, so that the value is computed once however often it is looked at.
    each = places.select("key", "row", "i", "pattern", F.explode_outer(F.array(value)).alias("instance"))
    base = F.get(F.array(*map(F.lit, KINDS)), F.instr(F.lit(MARKS), F.substring("instance", 1, 1)) - 1)
    kind = F.coalesce(base, F.when(_secret(F.col("instance")), F.lit("secret")))
    return each.where("instance <> ''").withColumn("kind", kind).where(
        F.col("kind").isNotNull() | ~F.col("instance").rlike(f"[{MARKS}]"))


def _places(scanned: DataFrame) -> DataFrame:
    # Outer, since Spark tests the array of a plain explode first, and would hash all words twice for that.
    each = _hashed(scanned).select("key", "row", F.posexplode_outer("words").alias("i", "e"))
    return each.select("key", "row", "i", "e.pattern", "e.w").where("pattern IS NOT NULL")


def words(scanned: DataFrame) -> DataFrame:
    """One row per word with a pattern: key, row, i (place among the words), pattern, instance, kind (null: unknown)."""
    return _spelt(_places(scanned))


def _doubt(score: str) -> Column:
    return F.log(F.greatest(1 - F.col(score), F.lit(1e-9)))


def _listed(table: DataFrame) -> tuple[DataFrame, int]:
    table = stored(table)
    n = table.count()
    return (F.broadcast(table) if n <= BROADCAST else table), n


def _scores(edges: DataFrame, known: DataFrame, patterns: DataFrame | None, trust: float) -> DataFrame:
    """Of the patterns in `edges`: pattern, kind, score (part of its instances that are known), known (how many surely)."""
    size = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    told = edges.select("pattern", "instance").join(known, "instance")
    if patterns is not None:  # what a pattern itself has said of an instance does not speak for the pattern
        told = told.join(patterns.where(F.col("score") >= WITNESS).select("pattern", "kind", "score"), ["pattern", "kind"], "left").withColumn(
            "s", F.when(F.col("log").isNull(), F.col("s")).otherwise(1 - F.exp(F.col("log") - F.coalesce(_doubt("score"), F.lit(0.0)))))
    sums = told.groupBy("pattern", "kind").agg(F.sum("s").alias("hits"), F.count(F.when(F.col("s") >= trust, 1)).alias("known"))
    return sums.join(size, "pattern").select("pattern", "kind", (F.col("hits") / (F.col("n") + DOUBT)).alias("score"), "known")


def _promising(pairs: DataFrame, known: DataFrame, trust: float, support: int) -> DataFrame:
    """Patterns that may reach `WITNESS` by their `pairs` (pattern, instance, kind) in texts with seeds: pattern."""
    if known is not None:
        best = known.groupBy("instance").agg(F.max("s").alias("ws"))
        pairs = pairs.join(best, "instance", "left")
    s = F.when(F.col("kind").isNotNull(), 1.0).otherwise(0.0 if known is None else F.coalesce("ws", F.lit(0.0)))
    rated = pairs.select("pattern", s.alias("s")).groupBy("pattern").agg(
        F.count("*").alias("n"), F.sum("s").alias("hits"), F.count(F.when(F.col("s") >= trust, 1)).alias("known"))
    return rated.where((F.col("known") >= support) & (F.col("hits") >= WITNESS * (F.col("n") + DOUBT))).select("pattern")


def bootstrap(scanned: DataFrame, trust: float = TRUST, support: int = SUPPORT) -> tuple[DataFrame, DataFrame] | None:
    """Trusted patterns (pattern, kind, score), one kind each, and places (key, row, i, pattern) of all patterns looked up.

    None if no pattern has been worth looking up.
    """
    pairs = stored(words(scanned.where("seeded")).groupBy("pattern", "instance").agg(F.max("kind").alias("kind")))
    edges = pairs.where("kind IS NOT NULL")
    seeds = edges.select("instance", "kind").distinct().withColumns({"s": F.lit(1.0), "log": F.lit(None).cast("double")})
    asked, looked_up, witnessed, patterns, hits, known = None, None, None, None, None, seeds
    while True:
        new = _promising(pairs, witnessed, trust, support)
        new, n = _listed(new if asked is None else new.join(asked, "pattern", "left_anti"))
        if not n:
            break
        asked = new if asked is None else asked.unionByName(new)
        found = stored(_spelt(_places(scanned).join(new, "pattern")).where("kind IS NULL OR kind = 'secret'"))
        edges = stored(edges.unionByName(found.where("kind IS NULL").select("pattern", "instance", "kind").distinct()))
        places = found.select("key", "row", "i", "pattern")
        hits = places if hits is None else hits.unionByName(places)
        own = edges.join(asked, "pattern", "left_semi")
        patterns = stored(_scores(own, known, patterns, trust).where(F.col("known") >= support))
        # Several patterns back an instance like independent witnesses; seeds stay certain.
        witnessed = stored(own.where("kind IS NULL").select("pattern", "instance").join(patterns.where(F.col("score") >= WITNESS), "pattern")
                           .groupBy("instance", "kind")
                           .agg(F.sum(_doubt("score")).alias("log")).select("instance", "kind", (1 - F.exp("log")).alias("s"), "log"))
        known = seeds.unionByName(witnessed)
        fresh = witnessed.where(F.col("s") >= trust).select("instance").distinct()
        fresh, n = _listed(fresh if looked_up is None else fresh.join(looked_up, "instance", "left_anti"))
        if not n:
            break
        looked_up = fresh if looked_up is None else looked_up.unionByName(fresh)
        # Where an instance that has become known stands elsewhere, further patterns stand before it.
        seen = words(scanned).where("kind IS NULL").join(fresh, "instance").select("pattern", "instance", "kind")
        pairs = stored(pairs.unionByName(seen).groupBy("pattern", "instance").agg(F.max("kind").alias("kind")))
    if patterns is None:
        return None
    last = _scores(edges.join(asked, "pattern", "left_semi"), known, patterns, trust).where((F.col("known") >= support) & (F.col("score") >= trust))
    best = last.groupBy("pattern").agg(F.max(F.struct("score", "kind")).alias("b"))
    return best.select("pattern", F.col("b.kind").alias("kind"), F.col("b.score").alias("score")), hits


def personal_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: key, row, base (array of spans) and spans (base and discovered ones).

    Discovered spans have order 4 and kind `<kind>_context`; none touches a base span.
    A null or empty text has none; rows of equal key and text get equal spans, and a null key is a key
    like any other. Columns of `docs` other than key and text are not read.
    """
    scanned = stored(scan(docs, key, text))
    found = bootstrap(scanned, **options)
    if found is None:
        return scanned.select(F.col("key").alias(key), "row", "base", F.col("base").alias("spans"))
    patterns, hits = found
    patterns, _ = _listed(patterns.select("pattern", F.col("kind").alias("guess")))
    new = (hits.join(patterns, "pattern").groupBy("key", "row")
           .agg(F.map_from_entries(F.collect_set(F.struct("i", "guess"))).alias("new"))
           .withColumnRenamed("key", "k").withColumnRenamed("row", "r"))

    def place(z: Column, guess: Column) -> Column:
        def span(start: Column) -> Column:
            head, value, _ = _parts(z["match"])
            return F.struct((start + F.length(head)).alias("start"), F.lit(len(KINDS)).alias("order"),
                            (start + F.length(head) + F.length(value)).alias("end"), F.concat(guess, F.lit("_context")).alias("kind"))
        # Marks are not part of the text.
        return let(F.length(F.translate(F.substring(F.col("marked"), F.lit(1), z["start"]), MARKS, "")), span)

    all_words = located(F.col("marked"), r"\S++")
    found = let(all_words, lambda w: F.transform(F.map_entries("new"), lambda e: place(F.get(w, e["key"]), e["value"])))
    new, _ = _listed(new)
    same = F.col("key").eqNullSafe(F.col("k")) & (F.col("row") == F.col("r"))
    more = scanned.join(new, same).select("key", "row", "base", F.sort_array(F.concat("base", found)).alias("spans"))
    rest = scanned.join(new, same, "left_anti").select("key", "row", "base", F.col("base").alias("spans"))
    return more.unionByName(rest).withColumnRenamed("key", key)


def written(spans: Column) -> Column:
    """kind:start:end joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span, or run of overlapping spans, replaced by <KIND> of its first."""
    def add(state: Column, s: Column) -> Column:
        more = F.array(text.substr(state["at"] + 1, s["start"] - state["at"]), F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= state["at"], F.concat(state["out"], more)).otherwise(state["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    whole = F.aggregate(spans, start, add, lambda state: F.concat(
        F.array_join(state["out"], ""), text.substr(state["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def mask_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """`docs` with all spans of the text masked; rows and other columns, whatever their names, stay as they are."""
    found = personal_spans(docs, key, text, **options).where(F.size("spans") > 0)
    # Repeated rows have equal spans; one of them is enough to join.
    k, r, own, spans = fresh_names(docs, "k", "r", "own", "spans")
    found = found.groupBy(F.col(key).alias(k), F.col("row").alias(r)).agg(F.first("spans").alias(spans))
    joined = docs.withColumn(own, F.xxhash64(F.col(key), F.col(text))).join(
        found.hint("merge"), F.col(key).eqNullSafe(F.col(k)) & (F.col(own) == F.col(r)), "left")
    new = F.when(F.col(spans).isNull(), F.col(text)).otherwise(masked(F.col(text), F.col(spans)))
    return joined.withColumn(text, new).select(*docs.columns)
