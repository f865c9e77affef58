"""Personal data in texts by weak supervision (op2), with DataFrame functions only.

Base spans are the matches of four patterns that pass their checks; they always stay. Looser patterns give more
candidates. Three labelers vote on every candidate: the patterns, a gazetteer (mail domains, issuer and
country prefixes) and the words before it. Expectation-maximisation over the counts of vote patterns (a table of bounded
size, counted over all documents) estimates how reliable each labeler is; the posterior of its vote pattern is
the soft label of a candidate. A naive Bayes span classifier is trained on these soft labels from shape, votes
and neighbouring characters. Looser candidates that it accepts, and that overlap no base span, are added.

Offsets are code points, end exclusive. NULL text is an empty text; every row has its own result, also
repeated rows and NULL doc_ids. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.llm.common import documents, query, stored, typed

KINDS = ("email", "ip", "card", "phone")
# The given patterns; each starts only where a run of its first class begins or the match before
# ended, which are the only places where a leftmost match can begin, and runs are possessive: a long
# run that is no match is read once, not once for each start in it.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
}
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
GAZETTEER = {
    "email": r"(?i)(mail|example|\.(com|org|net|edu|gov|io|de|fr|es)$)",
    "ip": r"^(?!0+\.|127\.|255\.)",
    "card": r"^(4|5[1-5]|2[2-7]|3[47]|6(011|5))",
    "phone": r"^(\+(1|33|34|44|49)\b|\(?[2-9][0-9]{2})",
}
CONTEXT = r"(?i)(mail|contact|write|phone|call|tel|fax|mobile|server|host|address|card|visa|pay|account)\W*$"
AGAINST = r"(?i)(version|isbn|order|invoice|part|serial|model|no\.|#)\W*$"
ROUNDS, ACCEPT = 50, 0.9


def _found(kind: str, pattern: str, loose: bool) -> str:
    """All matches of a pattern, with the gap before each and its neighbourhood."""
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    need = "" if loose or not NEEDS[kind] else f"contains(text, '{NEEDS[kind]}') and "
    return f"""if({need} text rlike '[0-9@(\\\\[]', element_at(transform(array(struct(
        regexp_extract_all(text, '{quoted}', 0) as m, split(text, '{quoted}', -1) as p)), z ->
      transform(filter(sequence(1, greatest(size(z.m), 1)), k -> k <= size(z.m)), k -> struct(
        '{kind}' as kind, {str(loose).lower()} as loose, k as k, char_length(get(z.p, k - 1)) as gap,
        get(z.m, k - 1) as match, right(get(z.p, k - 1), 24) as before, left(get(z.p, k), 1) as after))), 1),
      array())"""


def luhn(digits: Column) -> Column:
    n = F.char_length(digits)

    def step(total, i):
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step) % 10 == 0


def _valid() -> Column:
    """The checks that a base match must pass."""
    part = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    digits = F.regexp_replace("match", "[^0-9]", "")
    n = F.char_length(digits)
    return F.when(F.col("loose"), F.lit(False)).otherwise(
        F.when(F.col("kind") == "ip", F.col("match").rlike(rf"^{part}(\.{part}){{3}}$"))
        .when(F.col("kind") == "card", F.when(n.between(14, 19), luhn(digits)).otherwise(F.lit(False)))
        .when(F.col("kind") == "phone", n.between(10, 15))
        .otherwise(F.lit(True))
    )


def candidates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with a number each, and every match with its place, check and votes."""
    rows = typed(docs, doc_id="long", text="string").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row")
    )
    parts = [_found(k, p, False) for k, p in PATTERNS.items()] + [_found(k, p, True) for k, p in LOOSE.items()]
    rows = stored(rows.select("row", "doc_id", F.expr(f"concat({', '.join(parts)})").alias("found")), "matches")
    each = rows.where("size(found) > 0").select("row", F.explode("found").alias("f")).select("row", "f.*")
    so_far = Window.partitionBy("row", "kind", "loose").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.withColumn("end", F.sum(F.col("gap") + F.char_length("match")).over(so_far)).withColumn(
        "start", F.col("end") - F.char_length("match")
    ).withColumn("base", _valid()).where("base or loose")
    gazetteer = F.lit(False)
    for kind, pattern in GAZETTEER.items():
        gazetteer = F.when(F.col("kind") == kind, F.col("match").rlike(pattern)).otherwise(gazetteer)
    around = F.when(F.col("before").rlike(AGAINST), 0).when(F.col("before").rlike(CONTEXT), 1).otherwise(-1)
    voted = placed.select(
        "row", "kind", "loose", "base", "start", "end", F.col("base").cast("int").alias("v1"),
        gazetteer.cast("int").alias("v2"), around.alias("v3"),
        F.least(F.char_length("match").cast("int"), F.lit(40)).alias("length"),
        F.regexp_replace(F.right("before", F.lit(1)), r"\w", "a").alias("left"),
        F.regexp_replace("after", r"\w", "a").alias("right"),
    )
    return rows.select("row", "doc_id"), stored(voted, "candidates")


def reliabilities(patterns: list[tuple[tuple[int, ...], int]]) -> dict[tuple[int, ...], float]:
    """Dawid-Skene for two classes: the posterior of every vote pattern (-1: no vote)."""
    if not patterns:
        return {}
    total = sum(n for _, n in patterns)
    truth = {v: (1 + sum(x == 1 for x in v)) / (2 + sum(x >= 0 for x in v)) for v, _ in patterns}
    for _ in range(ROUNDS):
        prior = (1 + sum(n * truth[v] for v, n in patterns)) / (2 + total)
        says = []
        for k in range(len(patterns[0][0])):
            seen = [(v, n) for v, n in patterns if v[k] >= 0]
            good = sum(n * truth[v] for v, n in seen)
            bad = sum(n for _, n in seen) - good
            hit = sum(n * truth[v] for v, n in seen if v[k] == 1)
            false = sum(n * (1 - truth[v]) for v, n in seen if v[k] == 1)
            says.append(((hit + 2) / (good + 3), (false + 1) / (bad + 3)))
        for v, _ in patterns:
            odds = math.log(prior / (1 - prior))
            for x, (yes, no) in zip(v, says):
                if x >= 0:
                    odds += math.log(yes / no) if x else math.log((1 - yes) / (1 - no))
            truth[v] = 1 / (1 + math.exp(-max(min(odds, 30), -30)))
    return truth


FEATURES = ("kind", "v2", "v3", "length", "left", "right")


def span_scores(found: DataFrame) -> DataFrame:
    """Adds ``p``: the trained classifier's probability that a candidate is personal data."""
    votes = F.concat_ws(",", "v1", "v2", "v3")
    # Bounded: 2 * 2 * 3 vote patterns.
    counted = found.groupBy("v1", "v2", "v3").count().collect()
    soft = reliabilities([((r.v1, r.v2, r.v3), r["count"]) for r in counted])
    table = {",".join(map(str, v)): p for v, p in soft.items()}
    if not table:
        return found.withColumn("p", F.lit(0.0))
    lookup = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    labelled = found.withColumn("soft", lookup[votes])
    values = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).cast("string").alias("v")) for f in FEATURES])).alias("x")
    # Bounded: kinds, votes, lengths up to 40, and distinct neighbouring characters.
    sums = labelled.select("soft", values).groupBy("x.f", "x.v").agg(F.sum("soft").alias("good"), F.sum(1 - F.col("soft")).alias("bad")).collect()
    good = sum(r.good for r in sums) / len(FEATURES)
    bad = sum(r.bad for r in sums) / len(FEATURES)
    score = F.lit(math.log((good + 1) / (bad + 1)))
    for f in FEATURES:
        ratios = {r.v: math.log((r.good + 1) / (good + 2)) - math.log((r.bad + 1) / (bad + 2)) for r in sums if r.f == f and r.v is not None}
        weights = F.create_map(*[F.lit(x) for pair in sorted(ratios.items()) for x in pair])
        score = score + F.coalesce(weights[F.col(f).cast("string")], F.lit(0.0))
    return found.withColumn("p", 1 / (1 + F.exp(-score)))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, base, spans`` for every row: arrays of (start, kind number, kind, end), sorted."""
    rows, found = candidates(docs)
    scored = span_scores(found)
    place = Window.partitionBy("row").orderBy("start", "end")
    before = F.max(F.when(F.col("base"), F.col("end"))).over(place.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(F.col("base"), F.col("start"))).over(place.rowsBetween(1, Window.unboundedFollowing))
    alone = (F.coalesce(before, F.lit(-1)) <= F.col("start")) & (F.coalesce(after, F.col("end")) >= F.col("end"))
    kept = scored.withColumn("alone", alone).where(f"base or (alone and p >= {ACCEPT})")
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    span = F.struct("start", number.alias("number"), "kind", "end")
    per_row = kept.groupBy("row").agg(
        F.sort_array(F.collect_list(F.when(F.col("base"), span))).alias("base"),
        F.sort_array(F.collect_list(span)).alias("spans"),
    )
    return rows.join(per_row, "row", "left").select("doc_id", "base", "spans")


def written(spans: str) -> Column:
    return F.coalesce(F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","), F.lit(""))


@query("op2_personal_data")
def op2(spark, folder):
    found = find_personal_data(documents(spark, folder))
    counts = [
        F.when(F.col("base").isNull(), 0).otherwise(F.expr(f"size(filter(base, s -> s.kind = '{kind}'))")).cast("long").alias(f"n_{kind}")
        for kind in KINDS
    ]
    return found.select("doc_id", *counts, F.sha2(written("base"), 256).alias("base_sha256"), written("spans").alias("spans"))
