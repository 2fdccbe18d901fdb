"""Personal data: candidate spans from generators of high recall, judged by boosted trees.

Native: regular expressions, array functions and Spark ML only. The trained trees become a column
expression, so every text is read once in a narrow projection and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneloom.llm.tables import fresh, save

KINDS = ("email", "ip", "card", "phone")
CONTEXT = 24  # code points of context on either side

# Base patterns. Possessive quantifiers and the look-behind (a match starts where a run of its
# first characters starts, or where the last match ended) keep them linear; they find what the plain
# patterns find.
_LOCAL, _LABEL = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # A run of digits shorter than twelve can't be a card, wherever in it a match begins.
    "card": r"[0-9](?:[ -]?[0-9]){11,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# Wider generators: they overlap the base patterns and each other.
_AT, _DOT = r"(?: ?@ ?| ?[\[(]at[\])] ?| at )", r"(?:\.| ?[\[(]dot[\])] ?| dot )"
WIDE = {
    "email": rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}+{_AT}[A-Za-z0-9-]{{1,63}}+(?:{_DOT}[A-Za-z0-9-]{{1,63}}+){{1,8}}+",
    "ip": r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){3,7}+[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9]{4}(?:[ ./-][0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9+(])\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,5}(?![0-9])",
}
# Words near a span that speak for its kind, and words that speak against any.
CUES = {
    "email": r"(?i)e-?mail|contact|write|reach|mail",
    "ip": r"(?i)\bip\b|host|server|address|login",
    "card": r"(?i)card|visa|credit|payment|pay",
    "phone": r"(?i)phone|call|tel|mobile|fax|dial",
}
AGAINST = r"(?i)version|chapter|isbn|order|part|page|figure|item|build|meet|look|ticket|serial|range|time|ratio"
FEATURES = ("kind_number", "length", "digits", "separators", "base", "cue", "against", "luhn", "marked", "touching")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    numbers = F.transform(F.reverse(F.split(digits, "")), lambda c: c.cast("int"))
    doubled = F.transform(numbers, lambda d, i: F.when(i % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    return F.coalesce(F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0, F.lit(False))


def base_valid(kind: str, value: Column) -> Column:
    """The checks beyond the base pattern; failing matches are dropped without a retry."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return value.rlike(rf"\A{part}(?:\.{part}){{3}}\z")
    count = F.length(_digits(value))
    if kind == "card":
        return count.between(12, 19) & F.when(count.between(12, 19), passes_luhn(_digits(value))).otherwise(False)
    return count.between(9, 15)


CHUNK = 256  # elements that running values are carried through at a time


def held(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, of: Callable[[Column, Column], Column], zero: Column) -> Column:
    """Running values over an array, each element taken in: `of` is associative and `zero` changes nothing.

    An array built element by element is copied at every step, so it is done within chunks, and then over
    the chunks: the cost per element is bounded by CHUNK, not by the array.
    """

    def scan(array: Column) -> Column:
        start = F.struct(zero.alias("at"), F.slice(F.array(zero), 1, 0).alias("out"))

        def step(state: Column, value: Column) -> Column:
            now = of(state["at"], value)
            return F.struct(now.alias("at"), F.concat(state["out"], F.array(now)).alias("out"))

        return F.aggregate(array, start, step, lambda state: state["out"])

    def chunks(array: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(array) / CHUNK).cast("int"), F.lit(1)) - 1)
        return F.transform(numbers, lambda i: scan(F.slice(array, i * CHUNK + 1, CHUNK)))

    def whole(scanned: Column) -> Column:
        last = F.transform(scanned, lambda c: F.coalesce(F.get(c, F.size(c) - 1), zero))
        earlier = F.slice(F.concat(F.array(zero), scan(last)), F.lit(1), F.size(scanned))
        return F.flatten(F.zip_with(scanned, earlier, lambda chunk, b: F.transform(chunk, lambda v: of(b, v))))

    return held(values, lambda array: held(chunks(array), whole))


def _spans(kind: str, base: bool, matches: Column, gaps: Column) -> Column:
    """Array of (kind, begin, end, value, left, right, base); places count code points.

    The gaps between matches and the matches alternate, so places are running sums of lengths.
    """
    lengths = F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), matches, lambda g, m: F.length(g) + F.length(m))
    ends = running(lengths, lambda x, y: x + y, F.lit(0))
    places = F.zip_with(ends, matches, lambda end, m: F.struct((end - F.length(m)).alias("begin"), end.alias("end")))

    def span(place: Column, i: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            place["begin"].alias("begin"),
            place["end"].alias("end"),
            F.get(matches, i).alias("value"),
            F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("left"),
            F.left(F.get(gaps, i + 1), F.lit(CONTEXT)).alias("right"),
            F.lit(base).alias("base"),
        )

    found = F.transform(places, span)
    if base:
        found = F.filter(found, lambda s: base_valid(kind, s["value"]))
    empty = F.array().cast("array<struct<kind:string,begin:int,end:int,value:string,left:string,right:string,base:boolean>>")
    return F.when(F.size(matches) > 0, found).otherwise(empty)


# What a text must have at least to hold a match, by kind and whether the pattern is the base one.
NEEDS = {
    ("email", True): "@", ("email", False): r"@|\bat\b",
    ("ip", True): r"[0-9]\.[0-9]", ("ip", False): r"[0-9A-Fa-f]:[0-9A-Fa-f]",
    ("card", True): r"[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]", ("card", False): r"[0-9]{4}[ ./-][0-9]{4}",
    ("phone", True): r"\+[0-9]", ("phone", False): r"[0-9]\)?[ .-][0-9]{3}",
}


def with_candidates(docs: DataFrame, text: Column, name: str) -> DataFrame:
    """Adds column `name`: the array of a text's candidates with their features `f`.

    Matches, gaps and spans are columns of their own steps, so that each pattern runs once per text.
    """
    runs = [(k, True, BASE[k]) for k in KINDS] + [(k, False, WIDE[k]) for k in KINDS]
    t = fresh(docs, f"{name}_text")
    matched, between = ([fresh(docs, f"{name}_{kind}_{i}") for i in range(len(runs))] for kind in ("match", "gap"))
    none = F.array().cast("array<string>")
    steps = docs.withColumn(t, text)
    possible = [F.when(F.col(t).rlike(NEEDS[k, b]), F.regexp_extract_all(t, F.lit(p), 0)) for k, b, p in runs]
    steps = steps.withColumns({m: F.coalesce(c, none) for m, c in zip(matched, possible)})
    steps = steps.withColumns({g: F.when(F.size(m) > 0, F.split(t, p, -1)) for g, m, (_, _, p) in zip(between, matched, runs)})
    spans = F.concat(*[_spans(k, b, F.col(m), F.col(g)) for m, g, (k, b, _) in zip(matched, between, runs)])
    steps = steps.withColumn(name, F.transform(spans, lambda s: s.withField("f", _features(s))))
    return steps.drop(t, *matched, *between)


def _features(span: Column) -> Column:
    """What the trees see of a candidate: an array of doubles in the order of FEATURES."""
    value, near = span["value"], F.concat_ws(" ", span["left"], span["right"])
    digits = _digits(value)
    cue = F.coalesce(*[F.when(span["kind"] == k, near.rlike(p)) for k, p in CUES.items()], F.lit(False))
    features = {
        "kind_number": F.coalesce(*[F.when(span["kind"] == k, F.lit(i)) for i, k in enumerate(KINDS)], F.lit(0)),
        "length": F.length(value),
        "digits": F.length(digits),
        "separators": F.length(F.regexp_replace(value, "[A-Za-z0-9]", "")),
        "base": span["base"],
        "cue": cue,
        "against": near.rlike(AGAINST),
        "luhn": F.when(F.length(digits).between(12, 19), passes_luhn(digits)).otherwise(False),
        "marked": value.rlike(r"[@+(\[]"),
        "touching": span["left"].rlike(r"[0-9A-Za-z.]\z") | span["right"].rlike(r"\A[0-9A-Za-z]"),
    }
    return F.array(*[F.coalesce(features[n].cast("double"), F.lit(0.0)) for n in FEATURES])


def score_column(model: GBTClassificationModel, features: Column) -> Column:
    """The boosted trees as one expression over an array of features: the probability of personal data."""

    def branch(node) -> Column:
        if node.getClass().getSimpleName() == "LeafNode":
            return F.lit(float(node.prediction()))
        split = node.split()
        return F.when(F.get(features, split.featureIndex()) <= F.lit(float(split.threshold())), branch(node.leftChild())).otherwise(branch(node.rightChild()))

    trees = [branch(tree._java_obj.rootNode()) * F.lit(float(weight)) for tree, weight in zip(model.trees, model.treeWeights)]
    return 1 / (1 + F.exp(-2 * reduce(Column.__add__, trees)))


# Training texts: sentences around values of each kind, labelled personal (1) or not (0).
_PERSONAL = {
    "email": ("contact me at {}", "my e-mail is {}", "write to {} today", "{}", "the mail {} for anne"),
    "ip": ("login from ip {}", "the host {} answered", "{}", "server address {}", "seen {} again"),
    "card": ("paid with card {}", "credit card {} on file", "{}", "visa {} expires soon", "and {} then"),
    "phone": ("call me on {}", "phone {}", "tel {} after six", "{}", "my mobile is {}"),
}
_OTHER = ("version {} of it", "look at chapter {}", "the order {} shipped", "isbn {}", "serial {} of the item", "page {}", "ratio {}", "build {}", "see {} there")
_VALUES = {
    ("email", 1): ("anne@mail.example.com", "b.lee@example.org", "j.roe [at] example [dot] com", "kim(at)mail.example(dot)net", "sam at example dot com", "pat @ example.org"),
    ("email", 0): ("meet at noon.then", "look at page.two", "arrive at gate.b", "stay at home dot more", "sit at tables. fast", "at rest at ease.now"),
    ("ip", 1): ("10.20.30.40", "192.168.4.77", "83.12.200.9", "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "fe80:0:0:0:202:b3ff:fe1e:8329", "203.0.113.5"),
    ("ip", 0): ("12:30:45:10", "1:2:3:4", "10:20:30:40", "3:4:5:6:7", "01:02:03:04", "4:3:2:1"),
    ("card", 1): ("4111 1111 1111 1111", "5500005555555559", "4012-8888-8888-1881", "4111.1111.1111.1111", "6011/1111/1111/1117", "378282246310005"),
    ("card", 0): ("1234 5678 9012 3456", "2020-2021-2022-2023", "1000.2000.3000.4000", "1111 2222 3333 4445", "1990/1991/1992/1993", "0001-0002-0003-0004"),
    ("phone", 1): ("+1 (555) 010-9999", "(555) 010-9999", "555-010-4477", "+44 20 7946 0958", "555.010.4488", "020 7946 0958"),
    ("phone", 0): ("10 200 300", "12-345-678", "99.100.1000", "20 400 8000", "31.123.4567", "70-100-3000"),
}


def training_texts(spark: SparkSession) -> DataFrame:
    """The built-in labelled table (text, kind, personal), a few hundred rows; each text holds one value."""
    rows = []
    for (kind, personal), values in _VALUES.items():
        frames = (*_PERSONAL[kind], "and {} then") if personal else _OTHER
        rows += [F.lit(f"{kind}\t{personal}\t{frame.format(value)}") for frame in frames for value in values]
    parts = F.split(F.col("row"), "\t")
    table = spark.range(1).select(F.explode(F.array(*rows)).alias("row"))
    return table.select(parts[2].alias("text"), parts[0].alias("kind"), parts[1].cast("double").alias("personal"))


def train_pii_model(labelled: DataFrame, precision: float = 0.98) -> tuple[GBTClassificationModel, dict[str, float]]:
    """Boosted trees over candidates of a small labelled table, and a threshold for each kind.

    A threshold is the lowest score at which at least `precision` of the kind's held-out candidates
    (every fifth text by hash) are personal; a kind without such a score gets 1, which selects none.
    """
    rows = with_candidates(save(labelled.coalesce(1)), F.col("text"), "found").select("text", "kind", "personal", F.explode("found").alias("c"))
    rows = rows.where(F.col("c.kind") == F.col("kind")).select("text", "kind", "personal", array_to_vector("c.f").alias("features"))
    rows = save(rows.withColumn("held", F.pmod(F.xxhash64("text"), F.lit(5)) == 0))
    model = GBTClassifier(labelCol="personal", featuresCol="features", maxIter=10, maxDepth=3, seed=7).fit(rows.where("NOT held"))
    score = vector_to_array(F.col("probability"))[1]
    scored = model.transform(rows.where("held")).select("kind", score.alias("score"), "personal").collect()
    thresholds = {}
    for kind in KINDS:
        own = sorted(((r.score, r.personal) for r in scored if r.kind == kind), reverse=True)
        right, lowest = 0.0, 1.0
        for i, (value, personal) in enumerate(own):
            right += personal
            last_of_ties = i + 1 == len(own) or own[i + 1][0] < value
            if last_of_ties and right >= precision * (i + 1):
                lowest = value
        thresholds[kind] = max(lowest, 0.5)
    return model, thresholds


@lru_cache(maxsize=1)
def _built_in_model(application: str) -> tuple[GBTClassificationModel, dict[str, float]]:
    """The model of the built-in table, trained once for each Spark application."""
    return train_pii_model(training_texts(SparkSession.active()))


def with_spans(docs: DataFrame, name: str, text_column: str = "text", labelled: DataFrame | None = None) -> DataFrame:
    """Adds column `name`: the sorted array of (begin, number of the kind, end, base) of a text.

    A candidate counts if it passes its base pattern's checks, or if it scores at least the
    threshold of its kind and overlaps no base span. Null texts count as empty. Row by row: no shuffle.
    """
    application = docs.sparkSession.sparkContext.applicationId
    model, thresholds = train_pii_model(labelled) if labelled is not None else _built_in_model(application)
    found = fresh(docs, f"{name}_found")
    rows = with_candidates(docs, F.coalesce(F.col(text_column), F.lit("")), found)

    def counts(span: Column) -> Column:
        least = F.coalesce(*[F.when(span["kind"] == k, F.lit(t)) for k, t in thresholds.items()])
        return F.when(span["base"], F.lit(True)).otherwise(score_column(model, span["f"]) >= least)

    def place(span: Column) -> Column:
        number = F.coalesce(*[F.when(span["kind"] == k, F.lit(i)) for i, k in enumerate(KINDS)])
        return F.struct(span["begin"].alias("begin"), number.alias("number"), span["end"].alias("end"), span["base"].alias("base"))

    rows = rows.withColumn(found, F.transform(F.filter(found, counts), place))
    return rows.withColumn(name, _settled(F.col(found))).drop(found)


def _settled(found: Column) -> Column:
    """Base spans, and of the others those that overlap none of them; sorted.

    In sorted order a span overlaps an earlier base span if the farthest of their ends lies beyond its begin, and a
    later one if the next of their begins lies before its end.
    """

    def apart(spans: Column) -> Column:
        farthest = running(F.transform(spans, lambda s: F.when(s["base"], s["end"]).otherwise(0)), F.greatest, F.lit(0))
        never = F.lit(2**31 - 1)
        begins = F.transform(F.reverse(spans), lambda s: F.when(s["base"], s["begin"]).otherwise(never))
        following = F.reverse(running(begins, F.least, never))
        around = F.zip_with(farthest, following, lambda f, n: F.struct(f.alias("farthest"), n.alias("following")))
        rows = F.zip_with(spans, around, lambda s, a: F.struct(s.alias("span"), a["farthest"].alias("farthest"), a["following"].alias("following")))
        kept = F.filter(rows, lambda r: r["span"]["base"] | ((r["farthest"] <= r["span"]["begin"]) & (r["following"] >= r["span"]["end"])))
        return F.transform(kept, lambda r: r["span"])

    return held(F.array_sort(found), apart)


def _count(spans: Column, number: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["number"] == number)).cast("long")


def _digest_text(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["number"]), s["begin"].cast("string"), s["end"].cast("string"))), ","
    )


def pii_digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", labelled: DataFrame | None = None) -> DataFrame:
    """Per row: doc_id, counts of base spans by kind, the digest of the base spans, and all spans as text.

    Null and empty texts have no spans (counts 0, the digest of no bytes). Repeated rows come back
    repeated, an empty table gives an empty result, other columns are not read.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    found = with_spans(rows, "spans", "text", labelled).drop("text")
    base = F.filter("spans", lambda s: s["base"])
    counts = [_count(base, i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_digest_text(base), 256).alias("base_sha256"), _digest_text(F.col("spans")).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans become one, named by the first.

    Spans are sorted. The text is cut for each chunk of spans, and each chunk's part for its spans.
    """
    names = F.array(*map(F.lit, KINDS))

    def rebuilt(ends: Column) -> Column:
        at = F.slice(F.concat(F.array(F.lit(0)), ends), F.lit(1), F.size(spans))
        rows = F.zip_with(spans, at, lambda s, a: F.struct(s.alias("span"), a.alias("at")))
        apart = F.filter(rows, lambda r: r["span"]["begin"] >= r["at"])
        return F.concat(held(apart, parts), F.substring(text, F.element_at(ends, -1) + 1, F.length(text)))

    def parts(apart: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.ceil(F.size(apart) / CHUNK).cast("int") - 1)
        return F.array_join(F.transform(numbers, lambda i: held(F.slice(apart, i * CHUNK + 1, CHUNK), part)), "")

    def part(own: Column) -> Column:
        start = own[0]["at"]
        piece = F.substring(text, start + 1, F.element_at(own, -1)["span"]["begin"] - start)
        return held(F.struct(start.alias("start"), piece.alias("text")), lambda p: F.array_join(F.transform(own, lambda r: cut(p, r)), ""))

    def cut(piece: Column, row: Column) -> Column:
        before = F.substring(piece["text"], row["at"] - piece["start"] + 1, row["span"]["begin"] - row["at"])
        return F.concat(before, F.lit("["), F.get(names, row["span"]["number"]), F.lit("]"))

    ends = running(F.transform(spans, lambda s: s["end"]), F.greatest, F.lit(0))
    return F.when(F.size(spans) > 0, held(ends, rebuilt)).otherwise(text)


def redact_documents(docs: DataFrame, text_column: str = "text", count_column: str = "n_chars", labelled: DataFrame | None = None) -> DataFrame:
    """Every row with its spans redacted; `count_column`, if there is one, is counted anew where the text changed."""
    spans = fresh(docs, "pii_spans")
    rows = with_spans(docs, spans, text_column, labelled)
    hit = F.size(spans) > 0
    rows = rows.withColumn(text_column, F.when(hit, redacted(F.col(text_column), F.col(spans))).otherwise(F.col(text_column)))
    if count_column in docs.columns:
        kind = docs.schema[count_column].dataType
        rows = rows.withColumn(count_column, F.when(hit, F.length(text_column).cast(kind)).otherwise(F.col(count_column)))
    return rows.select(*docs.columns)
