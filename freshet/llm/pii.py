"""Personal data by candidate spans and gradient-boosted trees.

Base spans are matches of fixed patterns that pass their checks; they always stay. Beside them,
high-recall generators propose more spans, overlapping ones too: tokens with an at sign or a digit,
spelled-out addresses, and grouped digits of any style. Boosted trees score those by their format and
context (never by the checks themselves). They learn from the corpus, from all candidates in it: one that
meets a base span is an example of personal data, any other one is not known to be. Candidates the trees
cannot tell from confirmed ones are added, down to a score by kind from which on, among the third kept out
of training, at least `PRECISION` of the candidates with such scores are confirmed. So a number that
often fails the checks of its kind is left alone. Too few examples: nothing is added.

Candidates that agree in kind, features and confirmation are one row with their number as its weight, so the fit
grows with the formats in the corpus. Scores go in steps of 1 / `STEPS`; their counts by kind are complete, and
all that reaches the driver. (Where a feature may be split is proposed by Spark from 10,000 or more rows.)

Only column expressions and Spark's own trees. A match's place comes from the lengths of what lies
between matches, summed by a window over the document's matches, so it stays linear in their number.
Texts are scanned once; after that, only matches move.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.llm.frames import materialise, numbered

KINDS = ("email", "ip", "card", "phone")
# Fixed patterns. Possessive where giving back could not help; the guard before an address lets a
# match start only where its first run of letters does, or right after the last match.
_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENERATORS = {
    "at_token": r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D@]*+@[^\x20\x09-\x0D]*+",
    "spelled": r"[A-Za-z0-9._%+-]{1,64}\x20?[\[(]\x20?at\x20?[\])]\x20?[A-Za-z0-9-]{1,64}(?:(?:\.|\x20?[\[(]\x20?dot\x20?[\])]\x20?)[A-Za-z0-9-]{1,64}){1,8}",
    "digit_token": r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+",
    "grouped": r"\(?[0-9](?:[\x20().:/-]{0,2}+[0-9]){6,40}+",
}
MIN_EACH = 50
PRECISION = 0.95
STEPS = 10_000
FEATURES = (
    "n_chars", "n_digits", "n_letters", "n_upper", "n_hex", "n_dots", "n_dashes", "n_spaces", "n_marks", "n_groups",
    "longest_group", "first_digit", "first_letter", "has_at", "space_before", "letter_before", "space_after", "letter_after",
    "mark_after", "word_phone", "word_card", "word_mail", "word_address", "word_secret",
)


def _needs(name: str, text: Column) -> Column:
    """A cheap test that every match passes."""
    if name in ("email", "at_token"):
        return F.contains(text, F.lit("@"))
    if name == "phone":
        return F.contains(text, F.lit("+"))
    if name == "spelled":
        return F.contains(text, F.lit("at")) & text.rlike(r"[\[(]\x20?at\x20?[\])]")
    return text.rlike("[0-9]")


def _matches(text: Column, name: str, pattern: str) -> Column:
    """The pattern's leftmost matches: what they are, how far after the last they start, what is around."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def one(m: Column, gap: Column, i: Column, after: Column) -> Column:
        return F.struct(
            F.lit(name).alias("by"),
            i.cast("long").alias("i"),
            F.length(gap).cast("long").alias("gap"),
            m.alias("m"),
            F.right(gap, F.lit(24)).alias("before"),
            F.left(after, F.lit(8)).alias("after"),
        )

    zipped = F.arrays_zip(found.alias("m"), between.alias("gap"), F.slice(between, F.lit(2), F.size(found)).alias("after"))
    listed = F.transform(zipped, lambda z, i: one(z["m"], z["gap"], i, z["after"]))
    # The last piece between has no match of its own.
    return F.when(_needs(name, text), F.filter(listed, lambda z: z["m"].isNotNull()))


def _valid() -> Column:
    digits = F.regexp_replace("m", r"[^0-9]", "")
    return (
        F.when(F.col("by") == "email", F.lit(True))
        .when(F.col("by") == "ip", F.col("m").rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
        .when(F.col("by") == "card", F.length(digits).between(14, 19) & F.call_function("luhn_check", digits))
        .when(F.col("by") == "phone", F.length(digits).between(10, 15))
        .otherwise(False)
    )


def spans(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(rows, found): every row's `_row` and `doc_id`, and every span, base and proposed, with its
    place in code points. Null text counts as empty and has none."""
    source = numbered(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")))
    lists = [F.coalesce(_matches(F.col("text"), n, p), F.array()) for n, p in {**BASE, **GENERATORS}.items()]
    scanned = materialise(source.select("_row", "doc_id", F.concat(*lists).alias("found")), "matches")
    so_far = Window.partitionBy("_row", "by").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        scanned.filter(F.size("found") > 0)
        .select("_row", F.inline("found"))
        .withColumn("end", F.sum(F.col("gap") + F.length("m")).over(so_far))
        .withColumn("start", F.col("end") - F.length("m"))
        .withColumn("base", F.col("by").isin(*BASE))
        .filter(~F.col("base") | _valid())
    )
    return scanned.select("_row", "doc_id"), materialise(_known(found), "spans")


def _known(found: DataFrame) -> DataFrame:
    """`confirmed`: whether a proposed span meets a base span; `kind` by what it looks like."""
    in_order = Window.partitionBy("_row").orderBy("start", "end", "by")
    base_end = F.max(F.when(F.col("base"), F.col("end"))).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    base_start = F.min(F.when(F.col("base"), F.col("start"))).over(in_order.rowsBetween(1, Window.unboundedFollowing))
    meets = F.coalesce(base_end > F.col("start"), F.lit(False)) | F.coalesce(base_start < F.col("end"), F.lit(False))
    n_digits = F.length(F.regexp_replace("m", "[^0-9]", ""))
    kind = (
        F.when(F.col("base"), F.col("by"))
        .when(F.col("by").isin("at_token", "spelled") | F.contains("m", F.lit("@")), F.lit("email"))
        .when(F.col("m").rlike(r"^[^0-9]*[0-9]+(?:\.[0-9]+){3}[^0-9]*$"), F.lit("ip"))
        .when(n_digits >= 13, F.lit("card"))
        .otherwise("phone")
    )
    return found.withColumn("confirmed", ~F.col("base") & meets).withColumn("kind", kind)


def with_features(candidates: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and one for each of `FEATURES`."""
    count = lambda cls: F.length(F.regexp_replace("m", f"[^{cls}]", ""))
    groups = F.filter(F.split(F.col("m"), "[^0-9]+"), lambda g: g != "")
    near = F.lower(F.concat("before", F.lit(" "), F.col("m"), F.lit(" "), F.col("after")))
    flag = lambda c: c.cast("int")
    values = {
        "n_chars": F.length("m"), "n_digits": count("0-9"), "n_letters": count("A-Za-z"), "n_upper": count("A-Z"), "n_hex": count("a-f0-9"),
        "n_dots": count("."), "n_dashes": count(r"\-"), "n_spaces": count(r"\x20"), "n_marks": count(r"()+:/=\""), "n_groups": F.size(groups),
        "longest_group": F.coalesce(F.array_max(F.transform(groups, lambda g: F.length(g))), F.lit(0)),
        "first_digit": flag(F.col("m").rlike("^[0-9]")), "first_letter": flag(F.col("m").rlike("^[A-Za-z]")), "has_at": flag(F.contains("m", F.lit("@"))),
        "space_before": flag(F.col("before").rlike(r"(^|[\x20\x09-\x0D])$")), "letter_before": flag(F.col("before").rlike(r"\p{L}$")),
        "space_after": flag(F.col("after").rlike(r"^([\x20\x09-\x0D]|$)")), "letter_after": flag(F.col("after").rlike(r"^\p{L}")),
        "mark_after": flag(F.col("after").rlike(r"^[^\p{L}\p{N}\x20\x09-\x0D]")),
        "word_phone": flag(near.rlike("phone|tel|call|fax|mobil")), "word_card": flag(near.rlike("card|visa|iban|account|konto")),
        "word_mail": flag(near.rlike("mail|contact|write|@")), "word_address": flag(near.rlike(r"\bip\b|host|server|addr")),
        "word_secret": flag(near.rlike("pass|token|key|secret")),
    }
    return candidates.select(*keep, *[values[f].cast("double").alias(f) for f in FEATURES])


def assembled(features: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(features).drop(*FEATURES)


@dataclass
class Trees:
    model: GBTClassificationModel | None
    thresholds: dict[str, float]

    def score(self, features: DataFrame) -> DataFrame:
        """`score`, in whole steps, beside the columns other than the features."""
        scored = self.model.transform(assembled(features))
        steps = F.floor(vector_to_array("probability")[1] * F.lit(STEPS)) / F.lit(float(STEPS))
        return scored.withColumn("score", steps).drop("features", "rawPrediction", "probability", "prediction")


def calibrated(scored: Iterable[tuple[float, bool] | tuple[float, bool, int]], at_least: int = 20) -> float | None:
    """The lowest score down to which every stretch of scores is confirmed often enough: equal scores
    stay together, in stretches of `at_least` candidates. None if not even the highest are. A third
    value says how many candidates there are of such a score."""
    by_score: dict[float, list[int]] = {}
    for score, confirmed, *times in scored:
        counts = by_score.setdefault(score, [0, 0])
        counts[0] += times[0] if times else 1
        counts[1] += confirmed * (times[0] if times else 1)
    best, n, yes = None, 0, 0
    for score in sorted(by_score, reverse=True):
        n, yes = n + by_score[score][0], yes + by_score[score][1]
        if n >= at_least:
            if yes < PRECISION * n:
                break
            best, n, yes = score, 0, 0
    return best


def counted(found: DataFrame) -> DataFrame:
    """All proposed spans by kind, features and confirmation: how many, and whether they are held out. A third
    is, by a hash of row and place."""
    held = F.pmod(F.xxhash64("_row", "start", "end", "by"), F.lit(3)) == 0
    named = with_features(found.filter(~F.col("base")).withColumn("_held", held), "kind", "confirmed", "_held")
    return named.groupBy(*named.columns).agg(F.count(F.lit(1)).alias("n"))


def train(found: DataFrame, rounds: int = 12) -> Trees:
    """Trees on two thirds of all candidates and a threshold per kind from the other third, which the trees do
    not see."""
    candidates = materialise(counted(found), "candidates")
    learned = candidates.filter("not _held")
    n = {r["confirmed"]: r["n"] for r in learned.groupBy("confirmed").agg(F.sum("n").alias("n")).collect()}
    if min(n.get(True, 0), n.get(False, 0)) < MIN_EACH:
        return Trees(None, {})
    labelled = assembled(learned).select("features", F.col("confirmed").cast("double").alias("label"), F.col("n").cast("double"))
    trees = Trees(GBTClassifier(weightCol="n", maxIter=rounds, maxDepth=4, seed=3).fit(labelled), {})
    by_score: dict[str, list] = {k: [] for k in KINDS}
    scores = trees.score(candidates.filter("_held")).groupBy("kind", "score", "confirmed").agg(F.sum("n").alias("n"))
    for r in scores.collect():  # at most two for each kind and step
        by_score[r["kind"]].append((r["score"], r["confirmed"], r["n"]))
    for kind, scored in by_score.items():
        threshold = calibrated(scored)
        if threshold is not None:
            trees.thresholds[kind] = threshold
    return trees


def find(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(rows, spans): all rows, and the spans to redact: `_row`, `kind`, `start`, `end`, `base`, `score`.

    A null text is an empty one and has no spans. Texts are searched whole, and a row stands for itself: repeated
    rows and null ids each have their spans. Equal spans that two generators propose are one, with the higher
    score; a score of just the threshold is enough. No rows give none. Other columns are not read, whatever their
    names."""
    rows, found = spans(docs, text, id_col)
    trees = train(found)
    base = found.filter("base").select("_row", "kind", "start", "end", "base", F.lit(1.0).alias("score"))
    if not trees.thresholds:
        return rows, base
    enough = F.element_at(F.create_map(*[F.lit(x) for pair in trees.thresholds.items() for x in pair]), F.col("kind"))
    proposed = with_features(found.filter("not base and not confirmed"), "_row", "kind", "start", "end")
    added = trees.score(proposed).filter(F.col("score") >= enough)
    added = added.groupBy("_row", "kind", "start", "end").agg(F.max("score").alias("score"))
    return rows, base.unionByName(added.withColumn("base", F.lit(False)))


def digest(rows: DataFrame, found: DataFrame) -> DataFrame:
    """One row per row: counts of base spans, the hash of their list, and the list of all spans."""
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    name = F.concat_ws(":", "kind", "start", "end")
    item = F.struct("start", order.alias("order"), "end", name.alias("name"))
    listed = lambda when: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(when, item))), lambda s: s["name"]), ",")
    by_row = found.groupBy("_row").agg(
        *[F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS],
        listed(F.col("base")).alias("_base"),
        listed(F.lit(True)).alias("spans"),
    )
    joined = rows.join(by_row, "_row", "left")
    return joined.select(
        "_row",
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce("_base", F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def redact(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """`_row`, `doc_id` and the text with each span replaced by its kind in brackets; of spans that
    overlap, what a later one adds is removed too."""
    rows, found = find(docs, text, id_col)
    in_order = Window.partitionBy("_row").orderBy("start", "end")
    upto = F.coalesce(F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cuts = (
        found.withColumn("_from", upto)
        .groupBy("_row")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end", "_from", "kind"))).alias("cuts"))
    )
    source = numbered(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")))
    body = F.col("text")
    pieces = F.transform(
        "cuts",
        lambda c: F.concat(
            body.substr((c["_from"] + 1).cast("int"), F.greatest(c["start"] - c["_from"], F.lit(0)).cast("int")),
            F.when(c["end"] > c["_from"], F.concat(F.lit("["), c["kind"], F.lit("]"))).otherwise(""),
        ),
    )
    last = F.array_max(F.transform("cuts", lambda c: c["end"]))
    clean = F.when(F.col("cuts").isNull(), body).otherwise(
        F.concat(F.array_join(pieces, ""), body.substr((last + 1).cast("int"), F.length(body)))
    )
    return source.join(cuts, "_row", "left").select("_row", "doc_id", clean.alias("text"))
