"""Secret scan whose false positives a random forest removes. DataFrame functions and Spark's own forest only."""

from __future__ import annotations

import random
import string

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curveloom.llm.common import Workspace

#: A candidate is a whole run of these characters, at least 16 long, that no letter or digit touches.
CANDIDATE = r"(?<![\p{L}\p{N}+/_=-])[A-Za-z0-9+/_=-]{16,}(?![\p{L}\p{N}])"
#: Characters before and after a candidate that speak for or against it.
LEFT, RIGHT = 40, 20
#: At most this many findings of each label train the forest, those with the smallest hashes; so many are planted.
TRAIN_ROWS = 20_000
#: Words of three letters or more that count as the dictionary: those in most texts' words, at most so many.
DICTIONARY = 400
TREES, DEPTH, SEED = 20, 6, 11
FEATURES = ("length", "distinct", "digits", "upper", "vowels", "transitions", "alternation", "coverage", "path", "assigned", "quoted", "secret_word", "benign_word")
SECRET_WORDS = "token|key|secret|passw|pwd|auth|bearer|credential"
BENIGN_WORDS = "sha1|sha256|md5|commit|checksum|digest|uuid|etag|example|sample"


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, nth, candidate, before, after, path of every candidate in every whole text of docs(doc_id, text, source)."""
    found = docs.select(
        "doc_id",
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("path"),
        F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("c"),
        "text",
    ).where("size(c) > 0")
    pieces = found.select("doc_id", "path", "c", F.split("text", CANDIDATE, -1).alias("p"))
    each = F.transform(
        F.sequence(F.lit(0), F.size("c") - 1),
        lambda i: F.struct(
            i.alias("nth"),
            F.get("c", i).alias("candidate"),
            F.right(F.get("p", i), F.lit(LEFT)).alias("before"),
            F.left(F.get("p", i + 1), F.lit(RIGHT)).alias("after"),
        ),
    )
    return pieces.select("doc_id", "path", F.explode(each).alias("x")).select("doc_id", "x.nth", "x.candidate", "x.before", "x.after", "path")


def dictionary(ws: Workspace, docs: DataFrame, size: int = DICTIONARY) -> list[str]:
    """The most frequent words of 3 to 12 letters a-z over all texts, ties by code point."""
    words = docs.select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("w")).where(F.length("w").between(3, 12))
    top = words.groupBy("w").count().orderBy(F.desc("count"), "w").limit(size)
    return [r[0] for r in top.collect()]


def with_features(found: DataFrame, words: list[str]) -> DataFrame:
    """found(candidate, before, after, path) with the columns of FEATURES as doubles."""
    c = F.col("candidate")
    n = F.length(c).cast("double")
    share = lambda pattern: F.regexp_count(c, F.lit(pattern)) / n
    classes = r"(?<=[a-z])(?![a-z])(?=.)|(?<=[A-Z])(?![A-Z])(?=.)|(?<=[0-9])(?![0-9])(?=.)|(?<=[^A-Za-z0-9])(?=[A-Za-z0-9])"
    known = "|".join(sorted(words, key=lambda w: (-len(w), w)))
    left = F.lower("before")
    # `name=value` runs are one candidate; the name speaks as a neighbouring word.
    context = F.concat_ws(" ", left, F.regexp_extract(F.lower(c), r"^([a-z_]+)=", 1))
    values = {
        "length": n,
        "distinct": F.size(F.array_distinct(F.split(c, ""))) / n,
        "digits": share("[0-9]"),
        "upper": share("[A-Z]"),
        "vowels": share("(?i)[aeiou]"),
        "transitions": share(classes),
        "alternation": share("(?i)[aeiou][b-df-hj-np-tv-z]"),
        "coverage": 1 - F.length(F.regexp_replace(F.lower(c), f"(?:{known})", "")) / n if known else F.lit(0.0),
        "path": (left.rlike(r"(://|/|@|\\)[^\s]*$") | F.col("path").rlike("[/\\\\]")).cast("double"),
        "assigned": (left.rlike(r"[=:]\s*[\"']?$") | c.rlike(r"^[A-Za-z_]+=.")).cast("double"),
        "quoted": (left.rlike("[\"']$") & F.col("after").rlike("^[\"']")).cast("double"),
        "secret_word": context.rlike(f"(?:{SECRET_WORDS})[^a-z]*[a-z]*[^a-z]*$").cast("double"),
        "benign_word": context.rlike(f"(?:{BENIGN_WORDS})[^a-z]*[a-z]*[^a-z]*$").cast("double"),
    }
    return found.select("*", *[F.coalesce(values[k].cast("double"), F.lit(0.0)).alias(f"__{k}") for k in FEATURES])


def _vectors(found: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[f"__{k}" for k in FEATURES], outputCol="__features").transform(found)


def fit(labelled: DataFrame, words: list[str]) -> RandomForestClassificationModel | None:
    """A forest of labelled(candidate, before, after, path, label 0/1); None unless both labels occur.

    Of each label the TRAIN_ROWS findings with the smallest hashes are used. Rows with a null candidate or label are left out.
    """
    rows = labelled.where("candidate is not null and label in (0, 1)")
    order = F.xxhash64("candidate", "before", "after")
    parts = [rows.where(F.col("label") == k).orderBy(order, "candidate", "before", "after").limit(TRAIN_ROWS) for k in (0, 1)]
    train = _vectors(with_features(parts[0].unionByName(parts[1]), words)).withColumn("__label", F.col("label").cast("double")).select("__features", "__label").cache()
    try:
        if len(train.groupBy("__label").count().collect()) < 2:
            return None
        return RandomForestClassifier(featuresCol="__features", labelCol="__label", numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(train)
    finally:
        train.unpersist()


def score(found: DataFrame, model: RandomForestClassificationModel | None, words: list[str]) -> DataFrame:
    """found with p_secret and secret (p_secret >= 0.5); without a model no finding can be removed and p_secret is null."""
    if model is None:
        return found.withColumn("p_secret", F.lit(None).cast("double")).withColumn("secret", F.lit(True))
    model.setPredictionCol("").setRawPredictionCol("").setProbabilityCol("__p")
    p = model.transform(_vectors(with_features(found, words))).withColumn("p_secret", vector_to_array("__p")[1])
    return p.withColumn("secret", F.col("p_secret") >= 0.5).select(*found.columns, "p_secret", "secret")


class Planted:
    """Labelled findings of known making: what a generator of keys, tokens and passwords has written is a secret (1), what one of
    words, numbers, digests, names, paths and placeholders has written is not (0).

    The label follows from the generator alone. Neighbouring words are mostly those that go with it, but a share MISLEADING of
    all findings stands among plain words or among the other label's, so that no feature gives the label away.
    """

    MISLEADING = 0.15
    SECRET_LEFT = ('token = "', "api_key: '", "secret=", "Authorization: Bearer ", 'password = "', "export AUTH_TOKEN=", "the access key is ", '"credential": "', "login pwd: ")
    OTHER_LEFT = ("commit ", "sha256:", "checksum ", "md5 = ", "uuid: ", "number ", "order id ", "see http://example.org/", "from /usr/lib/", "etag: \"", "version ", "sample ")

    def __init__(self, words: list[str], seed: int):
        self.rng = random.Random(seed)
        self.words = words or ["word"]

    def of(self, letters: str, least: int, most: int) -> str:
        return "".join(self.rng.choices(letters, k=self.rng.randint(least, most)))

    def plain(self, n: int) -> str:
        return " ".join(self.rng.choices(self.words, k=n))

    def secret(self) -> str:
        hexa, mixed = "0123456789abcdef", string.ascii_letters + string.digits
        kind = self.rng.randrange(7)
        if kind == 0:
            return "AKIA" + self.of("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16, 16)
        if kind in (1, 2):
            return self.of(hexa, size := self.rng.choice((32, 40, 64)), size)
        if kind == 3:
            return self.rng.choice(("ghp_", "sk-", "xoxb-", "AIza")) + self.of(mixed, 24, 48)
        if kind == 4:
            return self.of(mixed + "+/", 22, 86) + "=" * self.rng.randrange(3)
        if kind == 5:
            return self.rng.choice(("password=", "passwd=", "secret_key=", "token=")) + self.of(mixed if self.rng.random() < 0.5 else hexa, 12, 40)
        return self.of(mixed, 16, 40)

    def other(self) -> str:
        rng, hexa = self.rng, "0123456789abcdef"
        kind = rng.randrange(9)
        if kind in (0, 1):
            run = ""
            while len(run) < 16:
                run += rng.choice(self.words)
            return (run, run.capitalize(), run.upper())[rng.choice((0, 0, 0, 1, 2))]
        if kind == 2:
            return self.of(string.digits, 16, 22)
        if kind == 3:
            return self.of(hexa, size := rng.choice((32, 40, 64)), size)
        if kind == 4:
            return "-".join(self.of(hexa, n, n) for n in (8, 4, 4, 4, 12))
        if kind == 5:
            return rng.choice("/_-").join(rng.choices(self.words, k=rng.randint(3, 6))).ljust(16, "x")
        if kind == 6:
            return "".join(w.capitalize() for w in rng.choices(self.words, k=rng.randint(4, 6))).ljust(16, "s")
        if kind == 7:
            return rng.choice("=-_x") * rng.randint(16, 60)
        return rng.choice(("your_api_key_goes_here", "example_secret_token", "insert-password-here", "secret=your_secret_key_here", "password=changeme_please"))

    def row(self) -> tuple[str, str, str, str, int]:
        label = self.rng.randrange(2)
        candidate = self.secret() if label else self.other()
        at = self.rng.random()
        lefts = (self.SECRET_LEFT if label else self.OTHER_LEFT) if at >= self.MISLEADING else (self.OTHER_LEFT if label else self.SECRET_LEFT) if at < self.MISLEADING / 2 else ("",)
        # What is told by its making stands among plain words as often as not; hex runs are told by their neighbours alone.
        left = "" if self.rng.random() < 0.4 and not set(candidate) <= set("0123456789abcdef") else self.rng.choice(lefts)
        after = (left[-1] if left[-1:] in ("'", '"') else "") + " " + self.plain(3)
        return candidate, f"{self.plain(4)} {left}"[-LEFT:], after[:RIGHT], self.rng.choice(("", "", "src/app/config.py")), label


def planted_findings(spark: SparkSession, words: list[str], rows: int = TRAIN_ROWS, seed: int = SEED) -> DataFrame:
    """So many labelled findings (candidate, before, after, path, label) by Planted, the same at every call with equal arguments."""
    made = Planted(words, seed)
    return spark.createDataFrame([made.row() for _ in range(rows)], "candidate string, before string, after string, path string, label int")


def secret_findings(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """doc_id, nth, candidate, before, after, path, p_secret, secret of every candidate in docs(doc_id, text, source).

    The forest is trained from `labelled` (candidate, before, after, path, label 0/1); without it from planted_findings(), so
    that no document teaches anything but the dictionary. before and after are the 40 and 20 characters beside a candidate.
    Null and empty texts have no candidates, long texts are read whole, a repeated row repeats its findings, null ids and
    sources stay, columns of other names are not read, an empty table gives no findings.
    """
    ws = Workspace(docs.sparkSession, "secrets")
    found = ws.stage(candidates(docs), "candidates")
    words = dictionary(ws, docs)
    if labelled is None:
        labelled = planted_findings(docs.sparkSession, words)
    return score(found, fit(labelled, words), words)
