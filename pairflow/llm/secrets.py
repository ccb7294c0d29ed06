"""Secret scan with a random forest against false positives.

Candidates are runs of 16 or more token characters, tokens of three dotted
parts, the password in a URL's user information, and behind a credential word
(password, token, ...) a value of any length and signs, to its closing quote or
to the next white space. A candidate's features are its
length, its character transitions (letter to digit and back, changes of case,
vowel to consonant), the part of it that common words of the corpus cover, path
marks in and around it, and its neighbouring words. A random forest trained
on labelled findings tells secrets from long words, numbers and paths.

DataFrame functions and Spark's own random forest only. A text is split once
by the candidate pattern, which gives every candidate with its surroundings
and position; texts are not copied per candidate. The dictionary is counted
over all documents, with partial sums before the shuffle.

Labelled findings are candidates with a 0/1 label; without any at hand,
`seed_labels` marks those of known formats and those assigned to a credential
word, on the documents outside the held out fold (on all, if these hold one
class only). Equal findings behind equal text train once. Each class has its
own bound, so secrets train however rare they are; a class weighs as much as
its distinct findings, the rarer one a tenth of the whole at least.

`seed_labels` gives no label to candidates that mix letters and digits without
a known format, nor to values behind a credential word that hold no digit or
are short: the forest scores them, but is not taught that they are harmless.

Not covered: secrets shorter than 16 characters, and ones with other signs than
[A-Za-z0-9+/_=-], that follow neither a credential word and a mark nor stand in
a URL; values joined to their word in prose ("the password is ..."); multi-line
keys beyond their long runs; escaped quotes inside a value.

Defined cases: null or empty text has no candidate; a candidate that occurs
several times in a text is one finding per place; findings depend on the text
alone, so repeated rows and copies have equal findings; if all labels are of
one class every candidate gets that class; an empty table gives no row. Only
doc_id and text are read.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_fraction, held_out, staged

CANDIDATE = r"[A-Za-z0-9+/_\-]{16,}={0,2}"
CONTEXT = 48
DICTIONARY = 300        # words, the commonest of the corpus
MAX_FINDINGS = 20_000   # distinct labelled findings that train, about, of each class
LEAST_SHARE = 0.1       # of the training weight, for the rarer class
TREES, DEPTH = 30, 7
THRESHOLD = 0.5
MARK = "[SECRET]"
_WORDS = (r"password|passwd|pwd|passphrase|token|secret|api[_-]?key|apikey|access[_-]?key|"
          r"private[_-]?key|auth|bearer|credential")
CREDENTIAL = rf"(?i)({_WORDS})s?[\"']?\s*(=|:|=>|\s)\s*[\"']?$"
USER_INFO = r"://[^\s/:@\"'<>]{0,64}:$"
# cheap looks first, for they are taken at every character
SECRET_OR_WORD = "|".join([
    r"(?<=:)(?=[^\s/:@\"'<>])(?<=://[^\s/:@\"'<>]{0,64}:)[^\s/\"'<>]+(?=@)",
    r"(?<=[=:>\s\"'])(?<=[=:>]\s{0,3}[\"']?)"
    rf"(?<=(?i:{_WORDS})s?[\"']?\s{{0,3}}(?:=>|=|:)\s{{0,3}}[\"']?)"
    r"(?:(?<=[\"'])[^\"'\r\n]++"
    r"|(?![=:>])[^\s\"'<>&]+(?:&(?!\w{1,40}=)[^\s\"'<>&]*){0,20}(?<![.,;:!?)\]}]))",
    r"(?<=\s)(?=\S{0,200}[0-9])(?=\S{0,200}[A-Za-z])"
    rf"(?<=(?i:{_WORDS})s?[\"']?\s{{1,3}})[^\s\"'<>=]+(?<![.,;:!?)\]}}])",
    r"eyJ[A-Za-z0-9_-]{10,}(?:\.[A-Za-z0-9_-]{4,}){1,2}",
    CANDIDATE])
KNOWN = (r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36,}$|^xox[baprs]-[A-Za-z0-9-]{10,}$"
         r"|^sk_live_[A-Za-z0-9]{16,}$|^eyJ[A-Za-z0-9_-]{10,}(\.[A-Za-z0-9_-]{4,}){0,2}$"
         r"|^AIza[A-Za-z0-9_-]{35}$|^glpat-[A-Za-z0-9_-]{20,}$|^npm_[A-Za-z0-9]{36}$")


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def candidates(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, start, finding, before, after) of every candidate."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = documents.select(
        "doc_id", text_key(text).alias("text_key"),
        F.regexp_extract_all(text, F.lit(SECRET_OR_WORD), F.lit(0)).alias("found"),
        F.split(text, SECRET_OR_WORD, -1).alias("between")).where(F.size("found") > 0)
    starts = F.aggregate(
        F.sequence(F.lit(1), F.size("found")),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
        lambda s, i: F.struct(
            (s["at"] + F.length(F.element_at("between", i))
             + F.length(F.element_at("found", i))).alias("at"),
            F.concat(s["starts"], F.array(s["at"] + F.length(F.element_at("between", i))))
            .alias("starts")),
        lambda s: s["starts"])
    split = split.withColumn("starts", starts)
    # a long name before "=" is a candidate itself, up to and with that mark
    def name(i):
        last = F.get("found", i - 2)
        return F.when(F.endswith(last, F.lit("=")), last).otherwise("")

    rows = F.transform(F.sequence(F.lit(1), F.size("found")), lambda i: F.struct(
        F.element_at("starts", i).alias("start"), F.element_at("found", i).alias("finding"),
        F.right(F.concat(name(i), F.element_at("between", i)), F.lit(CONTEXT)).alias("before"),
        F.left(F.element_at("between", i + 1), F.lit(CONTEXT)).alias("after")))
    return split.select("doc_id", "text_key", F.explode(rows).alias("c")).select(
        "doc_id", "text_key", "c.*")


def dictionary(documents: DataFrame, size: int = DICTIONARY) -> list[str]:
    """The commonest words of 3 to 8 plain letters over all documents."""
    words = documents.select(F.explode(F.regexp_extract_all(
        F.lower("text"), F.lit(r"\b[a-z]{3,8}\b"), F.lit(0))).alias("word"))
    rows = (words.groupBy("word").count().orderBy(F.desc("count"), "word").limit(size).collect())
    return [r["word"] for r in rows]


def features(found: DataFrame, words: list[str]) -> tuple[DataFrame, list[str]]:
    """The candidates with one column per feature, and the columns' names."""
    f, n = F.col("finding"), F.length("finding").cast("double")

    def share(pattern):
        return F.regexp_count(f, F.lit(pattern)) / n

    body = F.lower(f)
    cover = F.lit(0.0)
    if words:
        any_word = "|".join(sorted(words, key=lambda w: (-len(w), w)))
        cover = 1 - F.length(F.regexp_replace(body, any_word, "")) / n
    previous = F.lower(F.regexp_extract("before", r"([A-Za-z]+)[^A-Za-z]*$", 1))
    columns = {
        "f_length": n,
        "f_digits": share("[0-9]"), "f_upper": share("[A-Z]"), "f_lower": share("[a-z]"),
        "f_hex": share("[0-9a-f]"), "f_marks": share("[^A-Za-z0-9]"),
        # character transitions
        "f_letter_digit": share("[A-Za-z](?=[0-9])"), "f_digit_letter": share("[0-9](?=[A-Za-z])"),
        "f_case": share("[a-z](?=[A-Z])|[A-Z](?=[a-z])"), "f_digit_run": share("[0-9](?=[0-9])"),
        "f_vowel": share("[aeiouAEIOU](?=[b-df-hj-np-tv-zB-DF-HJ-NP-TV-Z])"),
        "f_distinct": F.size(F.array_distinct(F.split(f, ""))) / n,
        "f_cover": cover,
        # path
        "f_slashes": share("/"), "f_path": F.col("before").rlike(r"[/.]$").cast("double"),
        "f_url": F.col("before").rlike(r"://\S*$").cast("double"),
        # neighbouring words
        "f_credential": F.col("before").rlike(CREDENTIAL).cast("double"),
        "f_assigned": F.col("before").rlike(r"[=:]\s*[\"']?$").cast("double"),
        "f_quoted": (F.col("before").rlike(r"[\"']$") & F.col("after").rlike(r"^[\"']"))
        .cast("double"),
        "f_user_info": (F.col("before").rlike(USER_INFO) & F.col("after").startswith("@"))
        .cast("double"),
        "f_previous": F.length(previous).cast("double"),
        "f_common": (previous.isin(words) if words else F.lit(False)).cast("double"),
    }
    return found.withColumns(columns), list(columns)


def seed_labels(found: DataFrame) -> DataFrame:
    """Label by known formats, by assignment to a credential word and by place
    in a URL; null where none of these tells and the candidate may be a secret."""
    f, before = F.col("finding"), F.col("before")
    digits, long = f.rlike("[0-9]"), F.length(f) >= 6
    known = f.rlike(KNOWN) | (before.rlike(USER_INFO) & F.col("after").startswith("@"))
    # calls, placeholders and counts of tokens are no secrets
    harmless = (f.rlike(r"^[A-Za-z_][\w.]*[(\[]|^[$%{*]")
                | (before.rlike(r"(?i)tokens?[\"']?\s*[=:]?\s*[\"']?$") & f.rlike(r"^[0-9.,]{1,9}$")))
    named = before.rlike(CREDENTIAL) & ~harmless
    mixed = F.regexp_count(f, F.lit("[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])")) >= 4
    unsure = (named & before.rlike(r"[=:>]\s*[\"']?$")) | (mixed & ~harmless)
    return found.withColumn("label", F.when(known | (named & digits & long), 1.0)
                            .when(~unsure, 0.0))


FINDING_KEY = ("finding", "before")


def class_sizes(labelled: DataFrame) -> dict[float, int]:
    """Distinct findings of each label, about."""
    rows = (labelled.where("label IS NOT NULL").groupBy(F.col("label").cast("double").alias("label"))
            .agg(F.approx_count_distinct(F.xxhash64(*FINDING_KEY), 0.02).alias("n")).collect())
    return {r["label"]: max(r["n"], 1) for r in rows}  # 0 and 1


def training_rows(labelled: DataFrame, names: list[str],
                  bound: int = MAX_FINDINGS) -> tuple[DataFrame, list[float]]:
    """(label, weight, features) of about `bound` distinct findings of each
    class, and the classes that the labels hold."""
    sizes = class_sizes(labelled)
    whole = sum(sizes.values())
    share = {c: n / whole for c, n in sizes.items()}
    if len(share) == 2:
        rare = min(share, key=share.get)
        share[rare] = max(share[rare], LEAST_SHARE)
        share[1.0 - rare] = 1 - share[rare]
    key, drawn = F.concat_ws("|", *FINDING_KEY), F.lit(False)
    weight = F.lit(None).cast("double")
    for c, n in sorted(sizes.items()):
        of_class = F.col("label") == c
        drawn = drawn | (of_class & hash_fraction(key, bound, n, 53))
        # mean weight 1; a class that is drawn in part stands for all of it
        weight = F.when(of_class, F.lit(share[c] * sum(min(m, bound) for m in sizes.values())
                                        / min(n, bound))).otherwise(weight)
    rows = (labelled.withColumn("label", F.col("label").cast("double")).where(drawn)
            .groupBy(*FINDING_KEY, "label").agg(F.min(F.struct(*names)).alias("f")))
    return rows.select("label", weight.alias("weight"), "f.*"), sorted(sizes)


def scan(documents: DataFrame, labelled: DataFrame | None = None,
         threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, text_key, start, finding, score, is_secret) of every candidate.

    `labelled` holds findings (finding, before, after, label) to train on."""
    words = dictionary(documents)
    found, names = features(candidates(documents), words)
    found = staged(found, "candidates")
    if labelled is None:
        labelled = seed_labels(found.where(~held_out(F.col("doc_id"))))
        if len(class_sizes(labelled)) < 2:
            labelled = seed_labels(found)
    else:
        labelled, _ = features(labelled, words)
    train, kinds = training_rows(labelled, names)
    train = staged(train, "labelled-findings")
    if len(kinds) < 2:
        return found.select("doc_id", "text_key", "start", "finding",
                            F.lit(kinds[0] if kinds else 0.0).alias("score"),
                            F.lit(bool(kinds and kinds[0] >= threshold)).alias("is_secret"))
    model = Pipeline(stages=[
        VectorAssembler(inputCols=names, outputCol="features"),
        RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=19, labelCol="label",
                               weightCol="weight")]).fit(
            train)
    scored = model.transform(found)
    score = vector_to_array("probability")[1]
    return scored.select("doc_id", "text_key", "start", "finding", score.alias("score"),
                         (score >= threshold).alias("is_secret"))


def redact(documents: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """The documents with every secret replaced; n_chars, where it exists,
    follows. Secrets are joined back on the text, once per distinct text: each
    is replaced in its place, and long ones wherever else they stand."""
    anywhere = (F.length("finding") >= 16) | ((F.length("finding") >= 8)
                                              & F.col("finding").rlike("[0-9]"))
    secrets = (scan(documents, labelled).where("is_secret").groupBy("text_key")
               .agg(F.sort_array(F.collect_set(F.struct("start", F.length("finding").alias("n"))),
                                 asc=False).alias("places"),  # last first
                    F.sort_array(F.collect_set(F.when(anywhere, F.struct(
                        F.length("finding").alias("n"), "finding"))), asc=False).alias("s"))
               .select("text_key", "places", F.col("s.finding").alias("secrets")))  # longest first
    placed = F.aggregate(
        F.coalesce("places", F.array().cast("array<struct<start:int,n:int>>")), F.col("row.text"),
        lambda text, p: F.concat(F.substring(text, F.lit(1), p["start"]), F.lit(MARK),
                                 F.substring(text, p["start"] + p["n"] + 1, F.length(text))))
    clean = F.aggregate(
        F.coalesce("secrets", F.array().cast("array<string>")), placed,
        lambda text, s: F.replace(text, s, F.lit(MARK)))
    # the row travels as one struct, so its columns may have any names
    joined = (documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
                               text_key(F.col("text")).alias("key"))
              .join(secrets.withColumnRenamed("text_key", "key"), "key", "left"))
    changed = {"text": clean, "n_chars": F.when(F.col("secrets").isNull(), F.col("row.n_chars"))
               .otherwise(F.length(clean).cast("long"))} if "n_chars" in documents.columns else {
        "text": clean}
    return joined.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c)
                           for c in documents.columns])


def findings_digest(documents: DataFrame) -> DataFrame:
    """Findings without the secrets themselves."""
    return scan(documents).select(
        "doc_id", "start", F.length("finding").alias("length"),
        F.sha2("finding", 256).alias("finding_sha256"), "score", "is_secret")
