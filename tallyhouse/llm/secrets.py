"""Secrets in texts, with a random forest that removes false findings (op5), with DataFrame functions only.

A finding is a run of at least ``LEAST`` characters of ``[A-Za-z0-9+/_-]`` with a digit in it, the value
assigned to a secret's name (of any length and characters, up to its quote or a blank), or a provider format
anywhere, also inside a longer run. Findings may overlap; equal spans are one. Features are its length, shares of character classes, transitions between classes, distinct characters, the share
that dictionary words cover, path marks around it, and the words before it. The forest is trained on
labelled findings: a table of (match, before, after, label) if one is given, else findings that
provider formats or an assignment to a secret's name mark as real, and the rest as false. The training set is bounded
(``MOST_LABELLED`` findings of each label, those with the smallest hashes); all findings are scored.

Offsets are code points, end exclusive. NULL or empty text has no findings; repeated rows give theirs again; NULL
doc_ids are reported as NULL. Where all labels are equal every finding gets that label's score; without
findings the result is empty. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from tallyhouse.llm.common import documents, query, stored, typed

LEAST, MOST_LABELLED, TREES, DEPTH, ACCEPT = 14, 5000, 20, 6, 0.5
FINDING = r"(?:\G|(?<![A-Za-z0-9+/_-]))(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{%d,}+" % LEAST
PROVIDERS = (
    "AKIA[0-9A-Z]{16}", "gh[pousr]_[A-Za-z0-9]{36}", "xox[abp]-[A-Za-z0-9-]{20,}", "sk_live_[A-Za-z0-9]{16,}",
)
NAME = r"(?i:pass(?:word|wd)?|token|secret|api[_-]?key|credential)"
ASSIGNED = NAME + r"""["']?\s*[=:]\s*["']?$"""
# The value is looked at, not consumed, so an assignment inside a value is found as well.
VALUE = NAME + r"""["']?+\s*+[=:]\s*+["']?+(?=((?<=")[^"\r\n]++(?=")|(?<=')[^'\r\n]++(?=')|[^\s"']++))"""
DICTIONARY = (
    "the", "and", "for", "with", "name", "file", "test", "example", "sample", "page", "version", "order",
    "index", "data", "image", "default", "user", "item", "list", "http", "html", "report", "table", "id",
)
FEATURES = (
    "length", "digits", "upper", "lower", "marks", "transitions", "distinct", "hexadecimal", "covered", "path",
    "named", "assigned", "quoted", "first_letters",
)


def findings(docs: DataFrame) -> DataFrame:
    """``row, doc_id, start, end, match, before, after`` of every finding."""
    def spans(kind: int, pattern: str, needs: str, group: int = 0) -> str:
        """Matches of a pattern; with a group, what follows each match is the finding."""
        quoted, needed = (x.replace("\\", "\\\\").replace("'", "\\'") for x in (pattern, needs))
        found = f"regexp_extract_all(text, '{quoted}', 1)" if group else "cast(array() as array<string>)"
        ahead = "get(z.v, k - 1)" if group else "''"
        return f"""if(text rlike '{needed}', element_at(transform(array(struct(
            regexp_extract_all(text, '{quoted}', 0) as m, split(text, '{quoted}', -1) as p, {found} as v)), z ->
          transform(filter(sequence(1, greatest(size(z.m), 1)), k -> k <= size(z.m)), k -> struct(
            {kind} as kind, k as k, char_length(get(z.p, k - 1)) + char_length(get(z.m, k - 1)) as step,
            {"get(z.v, k - 1)" if group else "get(z.m, k - 1)"} as match, char_length({ahead}) as ahead,
            right({"concat(get(z.p, k - 1), get(z.m, k - 1))" if group else "get(z.p, k - 1)"}, 32) as before,
            left(substring(get(z.p, k), char_length({ahead}) + 1), 8) as after))), 1), array())"""

    kinds = [spans(0, FINDING, "[0-9]"), spans(1, VALUE, NAME, 1)]
    kinds += [spans(k, pattern, pattern) for k, pattern in enumerate(PROVIDERS, 2)]
    rows = typed(docs, doc_id="long", text="string").where("text is not null")
    made = F.expr(f"concat({', '.join(kinds)})")
    found = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", made.alias("found")).where("size(found) > 0")
    # Stored before the row numbers are used as keys: they are not the same on another run.
    each = stored(found, "findings").select("row", "doc_id", F.explode("found").alias("f")).select("row", "doc_id", "f.*")
    so_far = Window.partitionBy("row", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.withColumn("end", F.sum("step").over(so_far) + F.col("ahead")).select(
        "row", "doc_id", (F.col("end") - F.char_length("match")).alias("start"), "end", "match", "kind", "before", "after"
    )
    # A span found in several ways is one finding, with the surroundings that its first kind saw.
    return placed.groupBy("row", "start", "end").agg(
        F.first("doc_id").alias("doc_id"), F.first("match").alias("match"),
        F.min_by(F.struct("before", "after"), "kind").alias("near"),
    ).select("row", "doc_id", "start", "end", "match", "near.before", "near.after")


def featured(found: DataFrame) -> DataFrame:
    n = F.char_length("match")

    def share(pattern: str):
        return (n - F.char_length(F.regexp_replace("match", pattern, ""))) / n

    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        "match", "[^A-Za-z0-9]", "-"), "[a-z]", "a"), "[A-Z]", "b"), "[0-9]", "0")
    words = "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w)))
    values = {
        "length": n, "digits": share("[0-9]"), "upper": share("[A-Z]"), "lower": share("[a-z]"), "marks": share("[^A-Za-z0-9]"),
        "transitions": (F.char_length(F.regexp_replace(classes, r"(.)\1+", "$1")) - 1) / n,
        "distinct": F.size(F.array_distinct(F.split("match", ""))) / n,
        "hexadecimal": F.col("match").rlike("^([0-9a-f]+|[0-9A-F]+)$"),
        "covered": (n - F.char_length(F.regexp_replace(F.lower("match"), words, ""))) / n,
        "path": F.col("match").contains("/") | F.col("before").rlike(r"[/.\\]$") | F.col("after").rlike(r"^[/.][A-Za-z]"),
        "named": F.col("before").rlike(r"(?i)(pass|token|secret|key|credential|auth)"),
        "assigned": F.col("before").rlike(r"[=:]\s*[\"']?$"),
        "quoted": F.col("before").rlike("[\"']$"),
        "first_letters": F.char_length(F.regexp_extract("match", "^[A-Z]*", 0)),
    }
    return found.select("*", *[values[name].cast("double").alias(name) for name in FEATURES])


def rule_labels(found: DataFrame) -> DataFrame:
    real = F.col("match").rlike("|".join(PROVIDERS)) | F.col("before").rlike(ASSIGNED)
    return found.withColumn("label", real.cast("double"))


def find_secrets(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """``doc_id, start, end, score, match_sha256`` of the findings that the forest accepts. Runs jobs."""
    found = stored(featured(findings(docs)), "featured")
    known = rule_labels(found) if labelled is None else featured(
        typed(labelled, match="string", before="string", after="string", label="double").fillna("", ["before", "after"])
        .where("char_length(match) > 0 and label is not null")
    )
    # The same text in the same place teaches nothing new: one of each.
    known = known.select("match", "label", *FEATURES).dropDuplicates(["match", "label"])
    picked = None
    for value in (0.0, 1.0):
        part = known.where(F.col("label") == value).orderBy(F.xxhash64("match"), "match").limit(MOST_LABELLED)
        picked = part if picked is None else picked.union(part)
    picked = stored(picked.coalesce(1), "labelled")  # bounded: 2 * MOST_LABELLED rows
    seen = sorted(r.label for r in picked.select("label").distinct().collect())
    if len(seen) < 2:
        scored = found.withColumn("score", F.lit(seen[0] if seen else 0.0))
    else:
        gather = VectorAssembler(inputCols=list(FEATURES), outputCol="vector")
        forest = RandomForestClassifier(
            featuresCol="vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=7, subsamplingRate=0.7,
        ).fit(gather.transform(picked))
        scored = forest.transform(gather.transform(found)).withColumn("score", vector_to_array("probability")[1])
    return scored.where(F.col("score") >= ACCEPT).select(
        "doc_id", "start", "end", "score", F.sha2("match", 256).alias("match_sha256")
    )


@query("op5_secrets")
def op5(spark, folder):
    return find_secrets(documents(spark, folder))
