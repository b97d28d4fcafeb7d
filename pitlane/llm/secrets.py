"""Secret scans with a random forest that removes false positives.

Candidates are the whole values behind a credential's name, quoted or not, whatever
their length and characters, passwords in URLs, and runs of at least ``LEAST``
characters that keys and tokens are made of, also with dots.  Each is described by its length, its character transitions (changes
of character class, and how likely its letter pairs are in words), its dictionary
coverage (letter triples that occur in words), the path it was found under and
its neighbouring words (assignment, quotes, and how often the word before
leads a true finding).  A random forest trained from labelled findings gives each
candidate's probability of being a secret.

Everything runs on DataFrame functions and Spark ML.  The forest, the letter
statistics and the leading words come from a bounded sample of labelled findings, about
``SAMPLE`` of each label.  Where a table brings no labels, ``weak_labels`` stands
in: values assigned to a credential's name, quoted or not, and tokens of known kinds are
true findings, candidates between two real words with no credential's name near
false ones, and all others stay unlabelled.

Defined cases: null and empty texts have no candidates; whole texts are
scanned, in time linear in their length; names, blanks, URL users and values may have any length; positions count code points; a null path is an empty one; without
findings of both labels the weak label decides; repeated rows are scanned each;
an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import staged

LEAST = 16
SAMPLE = 10_000
CONTEXT = 64  # characters of context on either side
BLOCK = 256  # matches of a text whose lengths are summed at once
CUES = 256  # leading words the model knows, at most
SEEN = 3  # times a letter triple occurs in sampled words to count as in the dictionary
TREES, DEPTH = 20, 6
ACCEPT = 0.5

_NAME = r"(?i:token|secret|passw(?:or)?d|passphrase|passwd|pwd|credential|api[_-]?key|access[_-]?key|private[_-]?key|auth(?!or(?!i[sz])))"
_ID = r"[\w.\[\]\"'-]"  # names, with the brackets and quotes of subscripts and JSON keys
_IS = r"\s*+(?::=|=>|=|:)\s*+"
_RUN = r"[A-Za-z0-9+/_=-]"
_EDGE = r"(?<![\p{L}\p{N}+/_=-])"
# Groups that repeat are possessive: they cannot backtrack, so time is linear and no text exhausts the stack.
# A name is tried where it begins only; cheap conditions stand before those that search.
_NAMED = rf"(?={_ID}++\s*+[=:])(?={_ID}*?{_NAME}){_ID}++{_IS}"
_VALUE = "|".join(rf"{q}[^{q}\r\n]++(?={q})" for q in "\"'`") + r"|(?!//|[=:>])[^\s\"'`,;]++"
_ASSIGNED = rf"(?:(?<!{_ID})|\G){_NAMED}(?:{_VALUE})"
_USER = r"://[^\s:/@]*+:"
_URL = rf"{_USER}[^\s/\"'`]+(?=@)"
_END = r"(?![\p{L}\p{N}])"
_JWT = r"eyJ[\w-]{5,}+(?:\.[\w-]++)++"
_DOTTED = rf"{_EDGE}(?<!\.)(?={_RUN}{{2,}}+\.{_RUN})(?:{_JWT}|(?=(?:{_RUN}{{1,{LEAST - 1}}}+(?!{_RUN})\.(?={_RUN}))*+{_RUN}{{{LEAST}}}){_RUN}++(?:\.{_RUN}++)++){_END}"
_LONG = rf"{_EDGE}{_RUN}{{{LEAST},}}+{_END}"
#: What holds a candidate: a credential's name with its value, a URL's user and password, or a run of key characters, with dots or without.
CANDIDATE = rf"{_ASSIGNED}|{_URL}|{_DOTTED}|{_LONG}"
#: What stands before the candidate in such a match.
LEAD = rf"^(?:{_NAMED}(?:[\"'`]|(?!//|[=:>])(?=[^\s\"'`,;]))|{_USER})"
CREDENTIAL = rf"{_NAME}[\w.\[\]\"'-]*\s*(=|:|:=|=>)\s*[\"'`]$"
CREDENTIAL_UNQUOTED = rf"{_NAME}[\w.\[\]\"'-]*\s*(=|:|:=|=>)\s*$"
KNOWN = r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{20,}$|^github_pat_\w{20,}$|^glpat-[\w-]{16,}$|^xox[abprs]-[\w-]{10,}$|^[sr]k_live_\w{16,}$|^AIza[\w-]{30,}$|^eyJ[\w-]{5,}(\.[\w-]+)+$"
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_N = len(_LETTERS) + 1

FEATURES = (
    "length class_changes digits upper distinct pair_likelihood dictionary_coverage assigned quoted word_before letters_before "
    "path_depth path_example"
).split()


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """doc_id, path, start, candidate, before, after, kind: every candidate with its position and context.

    ``kind``: ``quoted`` or ``unquoted`` behind a credential's name, ``url``, or ``run``.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), text.alias("text"))
    found = found.where(F.col("text").rlike(CANDIDATE)).select(
        "doc_id", "path", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("found"), F.split("text", CANDIDATE, -1).alias("gaps")
    )
    found = found.withColumn("leads", F.transform("found", lambda c: F.regexp_extract(c, LEAD, 0)))
    # where each match begins: sums over whole blocks of matches, and over the rest of its own block
    found = found.withColumn("lengths", F.transform("found", lambda c, i: F.length(F.get("gaps", i)) + F.length(c)))

    def total(start: Column, n: Column) -> Column:
        return F.aggregate(F.slice("lengths", start + 1, n), F.lit(0), lambda t, x: t + x)

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size("lengths") - 1) / BLOCK).cast("int")), lambda k: total(k * BLOCK, F.lit(BLOCK)))
    found = found.withColumn("bases", F.aggregate(blocks, F.array(F.lit(0)), lambda sums, n: F.concat(sums, F.array(F.element_at(sums, -1) + n))))

    def last(c: Column) -> Column:
        return F.substring(c, -CONTEXT, CONTEXT)

    def described(c: Column, i: Column) -> Column:
        gap, following, lead = F.get("gaps", i), F.get("gaps", i + 1), F.get("leads", i)
        earlier, later = (F.coalesce(F.get("found", i + k), F.lit("")) for k in (-1, 1))
        kind = F.when(lead == "", "run").when(lead.startswith("://"), "url").when(lead.rlike("[\"'`]$"), "quoted").otherwise("unquoted")
        return F.struct(
            (F.get("bases", F.floor(i / BLOCK).cast("int")) + total(i - i % BLOCK, i % BLOCK) + F.length(gap) + F.length(lead)).cast("long").alias("start"),
            F.substr(c, F.length(lead) + 1).alias("candidate"),
            last(F.concat(last(earlier), last(gap), last(lead))).alias("before"),
            F.substring(F.concat(F.substring(following, 1, CONTEXT), F.substring(later, 1, CONTEXT)), 1, CONTEXT).alias("after"),
            kind.alias("kind"),
        )

    return found.select("doc_id", "path", F.explode(F.transform("found", described)).alias("c")).select("doc_id", "path", "c.*")


def weak_labels(findings: DataFrame) -> DataFrame:
    """Adds ``label``: 1 for values assigned to a credential's name and known kinds of token, 0 between two real words with no credential's name near, else null."""
    before, after, value, kind = F.col("before"), F.col("after"), F.col("candidate"), F.col("kind")
    telling = value.rlike(r"[^\p{L}]") | (F.length(value) >= LEAST)  # not ``auth: "basic"``
    quoted = ((kind == "quoted") | before.rlike(CREDENTIAL)) & after.rlike("^[\"'`]") & telling
    unquoted = ((kind == "unquoted") | before.rlike(CREDENTIAL_UNQUOTED)) & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.length(value) >= 8)
    url = kind == "url"
    cue = before.rlike(_NAME) | after.rlike(_NAME)
    plain = before.rlike(r"(^|\s)\p{L}+[.,;!?|]*\s+$") & after.rlike(r"^[.,;!?|]*\s+\p{L}+[.,;!?|#$%&*]*(\s|$)") & ~cue
    return findings.withColumn("label", F.when(quoted | unquoted | url | value.rlike(KNOWN), 1).when(plain, 0))


def _table(values: list[float]) -> Column:
    """A constant array of numbers, folded to one literal."""
    return F.split(F.lit(",".join(f"{v:.6g}" for v in values)), ",").cast("array<double>")


def _runs(value: Column, n: int) -> Column:
    """All spans of ``n`` characters."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(value) - n + 1, F.lit(1))), lambda i: F.substring(value, i, F.lit(n)))


def _grams(n: int, table: Column) -> Column:
    """Mean table entry over the runs of ``n`` letters in ``_chars``, the candidate's characters; 0 if it has none."""
    runs = F.transform(F.sequence(F.lit(0), F.greatest(F.size("_chars") - n, F.lit(0))), lambda i: F.concat(*[F.get("_chars", i + k) for k in range(n)]))
    runs = F.filter(runs, lambda s: s.rlike(f"^[a-z]{{{n}}}$"))

    def index(s: Column) -> Column:
        at = F.lit(0)
        for k in range(n):
            at = at * _N + (F.ascii(F.substring(s, k + 1, 1)) - 96)
        return at

    return F.coalesce(F.try_divide(F.aggregate(runs, F.lit(0.0), lambda t, s: t + F.get(table, index(s))), F.size(runs)), F.lit(0.0))


class Model:
    """Letter statistics, leading words and the forest; all bounded."""

    def __init__(self, pairs: list[float], triples: list[float], cues: list[tuple[str, float]], forest=None):
        self.pairs, self.triples, self.cues, self.forest = pairs, triples, cues, forest


def _word_before() -> Column:
    return F.lower(F.regexp_extract("before", r"([\p{L}_][\p{L}\p{N}_-]*)[^\p{L}\p{N}]*$", 1))


def features(findings: DataFrame, model: Model) -> DataFrame:
    """Adds the FEATURES of each finding."""
    c, n = F.col("candidate"), F.length("candidate")
    changes = F.regexp_count(c, F.lit("[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])|[a-z](?=[A-Z])|[A-Z](?=[a-z])"))
    if model.cues:
        cues = F.broadcast(findings.sparkSession.createDataFrame(model.cues, "_cue string, _odds double"))  # at most CUES rows
        findings = findings.join(cues, _word_before() == F.col("_cue"), "left")
    else:
        findings = findings.withColumn("_odds", F.lit(None).cast("double"))
    findings = findings.withColumn("_chars", F.split(F.lower(c), ""))  # read by position, which a string does in linear time only
    return findings.select(
        *[x for x in findings.columns if x not in ("_cue", "_odds", "_chars")],
        n.cast("double").alias("length"),
        (changes / n).alias("class_changes"),
        (F.regexp_count(c, F.lit("[0-9]")) / n).alias("digits"),
        (F.regexp_count(c, F.lit("[A-Z]")) / n).alias("upper"),
        (F.size(F.array_distinct(F.split(c, ""))) / n).alias("distinct"),
        _grams(2, _table(model.pairs)).alias("pair_likelihood"),
        _grams(3, _table(model.triples)).alias("dictionary_coverage"),
        F.col("before").rlike(r"[=:]\s*[\"'`]?$").cast("double").alias("assigned"),
        (F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")).cast("double").alias("quoted"),
        F.coalesce("_odds", F.lit(0.0)).alias("word_before"),
        (F.regexp_count("before", F.lit(r"\p{L}")) / F.greatest(F.length("before"), F.lit(1))).alias("letters_before"),
        F.regexp_count("path", F.lit("/")).cast("double").alias("path_depth"),
        F.col("path").rlike("(?i)(test|example|sample|fixture|mock|doc)").cast("double").alias("path_example"),
    )


def sampled(findings: DataFrame, most: int = SAMPLE) -> DataFrame:
    """About ``most`` findings of each label at most, by hash of their place."""
    sizes = findings.where("label IS NOT NULL").groupBy("label").agg(F.count(F.lit(1)).alias("_n"))  # two rows
    steps = 1 << 30
    kept = F.least(F.lit(1.0), F.lit(float(most)) / F.col("_n"))
    chosen = findings.join(F.broadcast(sizes), "label").where(F.pmod(F.xxhash64("doc_id", "start", "candidate"), F.lit(steps)) < kept * steps)
    return chosen.drop("_n")


def train(labelled: DataFrame, most: int = SAMPLE) -> Model:
    """Model from labelled findings (columns of ``candidates`` and ``label`` 0/1)."""
    sample = staged(sampled(labelled, most), "findings")
    words = sample.select(F.explode(F.regexp_extract_all(F.lower(F.concat_ws(" ", "before", "after")), F.lit("[a-z]{3,}"), F.lit(0))).alias("w"))
    counts: dict[int, dict[str, int]] = {}
    for n in (2, 3):
        grams = words.select(F.explode(_runs(F.col("w"), n)).alias("g"))
        counts[n] = {r["g"]: r["n"] for r in grams.groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most 26^3 rows
    total = sum(counts[2].values()) + _N * _N
    pairs, triples = [math.log(1 / total)] * _N**2, [0.0] * _N**3
    code = lambda g: sum((ord(c) - 96) * _N ** (len(g) - 1 - i) for i, c in enumerate(g))
    for g, n in counts[2].items():
        pairs[code(g)] = math.log((n + 1) / total)
    for g, n in counts[3].items():
        triples[code(g)] = float(n >= SEEN)
    before = sample.withColumn("w", _word_before()).where("w <> ''").groupBy("w").agg(F.sum("label").alias("t"), F.count(F.lit(1)).alias("n"))
    leading = before.where("n >= 3").orderBy(F.desc("t"), F.desc("n"), "w").limit(CUES).collect()  # bounded by CUES
    cues = [(r["w"], math.log((r["t"] + 0.5) / (r["n"] - r["t"] + 0.5))) for r in leading]
    model = Model(pairs, triples, cues)
    if sample.select("label").distinct().count() < 2:
        return model
    place = ["doc_id", "start", "candidate"]
    rows = staged(features(sample, model).select(*place, F.col("label").cast("double").alias("label"), *FEATURES), "features")
    rows = rows.repartition(4, *place).sortWithinPartitions(*place, *FEATURES)  # bounded; equal findings spread; the same order in reruns
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(rows)
    model.forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=17).fit(vectors)
    return model


def scan(docs: DataFrame, path: str = "source", labelled: DataFrame | None = None) -> DataFrame:
    """One row per candidate: doc_id, start, length, sha256 of the candidate, p_secret, is_secret.

    ``labelled`` are findings with labels; without them weak labels are used.
    """
    found = staged(weak_labels(candidates(docs, path)), "candidates")
    model = train(labelled if labelled is not None else found)
    if model.forest is None:
        scored = found.withColumn("p_secret", F.coalesce("label", F.lit(0)).cast("double")).withColumn("length", F.length("candidate"))
    else:
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(features(found, model))
        scored = model.forest.transform(vectors).withColumn("p_secret", vector_to_array("probability")[1])
    return scored.select(
        "doc_id", "start", F.col("length").cast("long"), F.sha2("candidate", 256).alias("candidate_sha256"), "p_secret",
        (F.col("p_secret") >= ACCEPT).alias("is_secret"),
    )
