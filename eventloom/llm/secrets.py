"""Secret scans: a random forest that tells secrets from look-alikes, in DataFrame functions and Spark ML only."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import FeatureHasher, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.base import written
from eventloom.llm.tokens import public_path

#: A run of 16 or more key characters; a candidate is such a run with a digit or eight capitals in a row.
RUN, KEY_LIKE = r"[A-Za-z0-9_+/-]{16,}", r"[0-9]|[A-Z]{8}"

#: Labelled findings of each class that the forest is fitted on, at most.
LABELLED_PER_CLASS = 10_000

TREES, DEPTH, SEED = 40, 8, 11

#: Buckets of the hashed context words.
CONTEXT_BUCKETS = 64

#: Words of the dictionary: the first of the public vocabulary with three to nine small letters.
DICTIONARY_WORDS = 600

# Shapes of keys that are known to be secrets, each with the text that must stand before it.
KNOWN_SECRETS = (
    ("", r"^AKIA[A-Z0-9]{16}$"),
    ("", r"^gh[pousr]_[A-Za-z0-9]{36}$"),
    ("", r"^xox[abprs]-[A-Za-z0-9-]{10,}$"),
    ("", r"^AIza[A-Za-z0-9_-]{35}$"),
    ("", r"^[rs]k_(live|test)_[A-Za-z0-9]{16,}$"),
    (r"(?i)(token|secret|api_?key)\W*$", r"(?i)^[0-9a-f]{32,}$"),
    (r"(?i)(password|passwd|pwd)\W*$", r"^[0-9A-Za-z]{16,}$"),
)

# Shapes of look-alikes: numbers, dates and times, paths of words, names of several words, UUIDs.
LOOK_ALIKES = (
    r"^[0-9_+/-]+$",
    r"^(?:[a-z]{2,}[0-9]{0,4}[_/-])+[a-z]{2,}[0-9]{0,4}$",
    r"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$",
)
#: What assigns the value behind it.
ASSIGNED = r"[=:]\W*$"


def dictionary(path: str | None = None, count: int = DICTIONARY_WORDS) -> list[str]:
    """Common words from the ranks of a public byte-level vocabulary, longest first."""
    with open(path or public_path("byte_bpe_50k.json"), encoding="utf-8") as file:
        ranks = json.load(file)["model"]["vocab"]
    words = [w[1:] for w in sorted(ranks, key=ranks.get) if w[:1] == "Ġ"]
    plain = [w for w in words if 3 <= len(w) <= 9 and w.isascii() and w.isalpha() and w.islower()]
    return sorted(plain[:count], key=lambda w: (-len(w), w))


def find_candidates(documents: DataFrame, document: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """Every candidate of every text: ``doc_id``, ``word_no``, ``part_no``, ``candidate``, its context and its path.

    ``before`` is what stands before the candidate in its word with the two words before that, ``after`` the rest
    of its word and the next word. Words are parted by white space.
    """
    where = F.coalesce(F.col(f"`{path}`").cast("string"), F.lit("")) if path in documents.columns else F.lit("")
    rows = documents.select(
        F.col(f"`{document}`").alias("doc_id"),
        where.alias("path"),
        F.split(F.coalesce(F.col(f"`{text}`"), F.lit("")), r"[\x20\x09-\x0D]+").alias("words"),
    )
    hits = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.rlike(F.col("words")[i], F.lit(RUN)))
    placed = rows.select("doc_id", "path", "words", F.explode(hits).alias("word_no"))
    word = F.col("words")[F.col("word_no")]
    near = placed.select(
        "doc_id",
        "path",
        "word_no",
        word.alias("word"),
        F.concat_ws(" ", F.slice("words", F.greatest(F.col("word_no") - 1, F.lit(1)), F.least(F.col("word_no"), F.lit(2)))).alias("left"),
        F.coalesce(F.get("words", F.col("word_no") + 1), F.lit("")).alias("right"),
    )
    parts = near.select("*", F.posexplode(_placed_runs(F.col("word"))).alias("part_no", "part"))
    candidate, place = F.col("part.run"), F.col("part.at")
    return parts.select(
        "doc_id",
        "path",
        "word_no",
        "part_no",
        candidate.alias("candidate"),
        F.concat_ws(" ", "left", F.substring(F.col("word"), F.lit(1), place - 1)).alias("before"),
        F.concat_ws(" ", F.substring(F.col("word"), place + F.length(candidate), F.length("word")), "right").alias("after"),
    )


def _placed_runs(word: Column) -> Column:
    """The candidates of a word with their places (from 1), in one pass over it.

    All runs are long, and what stands between two of them has none, so each is found from the end of the one before it.
    """

    def step(state: Column, run: Column) -> Column:
        at = F.call_function("locate", run, word, state["next"])
        return F.struct(
            (at + F.length(run)).alias("next"), F.array_append(state["found"], F.struct(run.alias("run"), at.alias("at"))).alias("found")
        )

    empty = F.array().cast("array<struct<run:string,at:int>>")
    runs = F.regexp_extract_all(word, F.lit(RUN), F.lit(0))
    every = F.aggregate(runs, F.struct(F.lit(1).alias("next"), empty.alias("found")), step)["found"]
    return F.filter(every, lambda x: F.rlike(x["run"], F.lit(KEY_LIKE)))


def rule_label(candidate: str = "candidate", before: str = "before") -> Column:
    """1 for a candidate with the shape and context of a known kind of secret, 0 for a clear look-alike, null for all others.

    Look-alikes have one of the shapes of names, paths, numbers and ids, or are assigned to nothing. An assigned value of
    an unknown kind may well be a secret, so it teaches neither.
    """
    hit = F.lit(False)
    for context, shape in KNOWN_SECRETS:
        own = F.rlike(F.col(candidate), F.lit(shape))
        hit = hit | (own & F.rlike(F.col(before), F.lit(context)) if context else own)
    alike = ~F.rlike(F.col(before), F.lit(ASSIGNED))
    for shape in LOOK_ALIKES:
        alike = alike | F.rlike(F.col(candidate), F.lit(shape))
    return F.when(hit, 1).when(alike, 0).cast("int")


NUMBERS = (
    "length",
    "digits",
    "capitals",
    "signs",
    "hex_only",
    "turns",
    "letter_turns",
    "variety",
    "coverage",
    "assigned",
)


def with_features(candidates: DataFrame, words: list[str]) -> DataFrame:
    """The numbers and context words of each candidate.

    Length; shares of digits, capitals and signs; whether it is hexadecimal; transitions between kinds of characters
    and between vowels and consonants, for each character; variety of characters; share of characters covered by
    dictionary words; whether it is assigned to something. Context: path, neighbouring words.
    """
    c, n = F.col("candidate"), F.length("candidate").cast("double")

    def share(pattern: str) -> Column:
        return F.regexp_count(c, F.lit(pattern)).cast("double") / n

    kinds = ("[0-9]", "[a-z]", "[A-Z]", "[_+/-]")
    turn = "|".join(f"(?<={a})(?={b})" for a in kinds for b in kinds if a != b)
    vowels = "(?<=[aeiouAEIOU])(?=[b-df-hj-np-tv-zB-DF-HJ-NP-TV-Z])|(?<=[b-df-hj-np-tv-zB-DF-HJ-NP-TV-Z])(?=[aeiouAEIOU])"
    uncovered = F.length(F.regexp_replace(F.lower(c), "|".join(words), "")).cast("double") if words else n

    def tail(column: str, pattern: str) -> Column:
        return F.lower(F.regexp_extract(column, pattern, 1))

    return candidates.withColumns(
        {
            "length": n,
            "digits": share("[0-9]"),
            "capitals": share("[A-Z]"),
            "signs": share("[_+/-]"),
            "hex_only": F.rlike(c, F.lit("(?i)^[0-9a-f]+$")).cast("double"),
            "turns": share(turn),
            "letter_turns": share(vowels),
            "variety": F.size(F.array_distinct(F.split(c, ""))).cast("double") / n,
            "coverage": F.lit(1.0) - uncovered / n,
            "assigned": F.rlike("before", F.lit(ASSIGNED)).cast("double"),
            "word_before": tail("before", r"([A-Za-z_]{1,20})\W*$"),
            "word_after": tail("after", r"^\W*([A-Za-z_]{1,20})"),
            "kind_of_path": tail("path", r"([^/]{1,40})$"),
        }
    )


@dataclass(frozen=True)
class Forest:
    """A fitted forest with the words of its dictionary."""

    model: PipelineModel
    words: list[str]

    def scored(self, candidates: DataFrame) -> DataFrame:
        """The candidates with ``probability`` of being a secret and ``is_secret``."""
        scored = self.model.transform(with_features(candidates, self.words))
        chance = F.round(vector_to_array("forest_probability")[1], 6)
        return scored.select(*candidates.columns, chance.alias("probability"), (chance >= 0.5).alias("is_secret"))


def fit_forest(labelled: DataFrame, words: list[str] | None = None, per_class: int = LABELLED_PER_CLASS) -> Forest | None:
    """A forest fitted on labelled findings (columns of :func:`find_candidates` and ``label``); None without both labels.

    At most about ``per_class`` findings of each label are used, drawn by a hash of the finding; with fewer, all.
    They are put into one task in a fixed order, so that a rerun fits the same forest.
    """
    labelled = labelled.where("label is not null")
    counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    if not (counts.get(0) and counts.get(1)):
        return None
    words = dictionary() if words is None else words
    code = F.xxhash64(*[F.coalesce(F.col(x), F.lit("")) for x in ("candidate", "before", "after", "path")])
    u = F.shiftrightunsigned(code, 11).cast("double") / F.lit(float(1 << 53))
    least = F.when(F.col("label") == 1, F.lit(per_class / counts[1])).otherwise(F.lit(per_class / counts[0]))
    drawn = with_features(labelled.where(u < least), words).withColumn("label", F.col("label").cast("double"))
    drawn = drawn.select(*NUMBERS, "word_before", "word_after", "kind_of_path", "label")
    drawn = written(drawn.repartition(1).sortWithinPartitions(*drawn.columns))
    steps = [
        FeatureHasher(inputCols=["word_before", "word_after", "kind_of_path"], outputCol="context", numFeatures=CONTEXT_BUCKETS),
        VectorAssembler(inputCols=[*NUMBERS, "context"], outputCol="features"),
        RandomForestClassifier(
            numTrees=TREES,
            maxDepth=DEPTH,
            seed=SEED,
            rawPredictionCol="forest_raw",
            probabilityCol="forest_probability",
            predictionCol="forest_prediction",
        ),
    ]
    return Forest(Pipeline(stages=steps).fit(drawn), words)


def scan_secrets(
    documents: DataFrame,
    findings: DataFrame | None = None,
    document: str = "doc_id",
    text: str = "text",
    path: str = "source",
    per_class: int = LABELLED_PER_CLASS,
) -> DataFrame:
    """Every candidate of every text with its probability of being a secret.

    ``findings`` are labelled candidates (columns of :func:`find_candidates` and ``label``, 1 for a secret); without
    them, the candidates of ``documents`` are labelled by :func:`rule_label`, and those it leaves open are decided by the forest. Result: ``doc_id``, ``word_no``,
    ``part_no``, ``candidate``, ``before``, ``after``, ``path``, ``probability`` and ``is_secret``.

    One pass over the texts writes the candidates, a small table; the forest is fitted on a bounded sample of the
    labelled ones and applied to all. Nothing but that sample is shuffled.

    Defined cases: a null or empty text has no candidate; a null path is empty; repeated rows give repeated findings; without labels
    of both kinds there is no forest, and every candidate has the rule's label (0 where it has none) as its probability; an empty table gives an empty
    result; other columns are not read.
    """
    found = written(find_candidates(documents, document, text, path))
    labelled = found.withColumn("label", rule_label()) if findings is None else findings
    forest = fit_forest(labelled, per_class=per_class)
    if forest is None:
        chance = F.coalesce(rule_label(), F.lit(0)).cast("double")
        return found.withColumns({"probability": chance, "is_secret": chance >= 0.5})
    return forest.scored(found)
