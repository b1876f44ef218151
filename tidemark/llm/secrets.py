"""Secret scanning with a random forest against false positives, in DataFrame functions only.

Candidates are runs that look like keys: sixteen or more characters of an identifier or base64 alphabet with at least one
digit, ``=`` only as padding at the end; and whatever of six or more signs is assigned to a name that speaks of a secret,
to the closing quote or, without quotes, to the next space. They are taken from the whole text with what stands before
and after. Each becomes a row of numbers: length, character
transitions, coverage by a dictionary of words that code and prose are made of, hints in the path, and hints in the
neighbouring words. A random forest trained on labelled findings scores them; what stays below the limit is a false
positive.

The forest is trained by Spark's own DataFrame-based learner on labelled findings (candidate, left, right, path, label);
without any, on a set that Spark makes by rule: keys as services issue them where code assigns them, against commit ids,
checksums, identifiers, numbers, file names and placeholders.

Defined cases: null text is empty and has no candidate; a null path has no hint; candidates that repeat are rows of their
own, at their own place; texts are read whole; an empty table gives an empty result; ids are passed on as they are.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import whole_text
from tidemark.session import cut_lineage

_RUN = r"(?<![A-Za-z0-9+/_\-])(?=[A-Za-z+/_\-]*[0-9])[A-Za-z0-9+/_\-]{16,}+(?:={1,2}(?![A-Za-z0-9+/_=\-\"'`]))?"
# Values of a secret-like name. The short tests come first, as they are made at every place of a text.
_NAMED = (
    r"(?i:secret|token|passw|pwd|passphrase|api.?key|access.?key|private.?key|auth|bearer|credential|signing)"
    r"[A-Za-z0-9_\-]{0,24}[\"'`]?[ \t]{0,4}(?:=>|:=|=|:)[ \t]{0,4}"
)
_QUOTED = rf"(?<=[\"'`])(?<=[=:> \t][\"'`])(?<={_NAMED}[\"'`])[^\"'`\r\n]{{6,}}(?=[\"'`])"
# A value without quotes also ends before the next ``&name=``. Such an & is marked first, by a code point that Unicode keeps
# out of texts, so that a value is a run of one class of characters: groups that repeat are matched by recursion, and a
# long value would end the stack.
_NEXT_NAME = "&(?=[A-Za-z_]+=)"
_MARK = "\ufdd0"
_BARE = (
    r"(?<=[=:> \t])(?![=>\s\"'`])(?<=[=:>][ \t]{0,4})"
    rf"(?<={_NAMED})[^\s\"'`,;<>{_MARK}]{{6,}}+"
)
CANDIDATE = f"{_QUOTED}|{_BARE}|{_RUN}"
# Characters of context on either side.
LEFT, RIGHT = 48, 24
LIMIT = 0.5
TREES, DEPTH, SEED = 24, 7, 11
# Labelled findings made by rule.
TRAINING_ROWS = 4_000

# Words whose presence inside a candidate speaks for a name or a phrase.
DICTIONARY = (
    "about account action address alpha android archive article assets author backup banner beta block board book build "
    "button cache category center chapter check class client code color column comment common component config content "
    "controller count country create data date default delete demo design detail device dialog document domain download "
    "draft element email error event example export feature field file filter final first folder font footer form format "
    "frame function group handler header height help history home icon image import index info input install item java "
    "label language large layout legacy level library link list local login main manager media menu message method mobile "
    "model module month name network news number object option order package page panel parent part password path person "
    "photo picture play point policy post press price print private process product profile project property public query "
    "queue read record region release report request resource response result review right root route sample schema screen "
    "search second section select server service session setting short sign size small source stage start state static "
    "status step stock storage store street string style submit summary support system table target task team template "
    "test text theme time title token tool track type update upload user utils value vendor version video view volume "
    "week weight widget width window work world write year"
).split()
SECRET_WORDS = "secret|token|passw|passwd|pwd|api_?key|apikey|access_?key|private_?key|auth|bearer|credential|signing"
OTHER_WORDS = (
    "commit|sha1|sha256|sha512|md5|checksum|digest|integrity|hash|uuid|guid|isbn|version|order|invoice|phone|iban|card|"
    "account|tracking|serial|revision|build|file|image|photo|example|sample|dummy|placeholder|test"
)
KEY_PREFIXES = "AKIA|ASIA|ghp_|gho_|ghs_|sk-|sk_live|rk_live|AIza|xox[abprs]-|eyJ|SG"
TEST_PATH = "test|spec|example|sample|fixture|mock|docs?/|demo"
CONFIG_PATH = r"config|secret|deploy|settings|credential|\.env|\.ya?ml|\.pem|\.ini"

FEATURES = (
    "f_length", "f_digits", "f_distinct", "f_letter_digit", "f_case", "f_clusters", "f_vowels", "f_hex", "f_parts",
    "f_runs", "f_dictionary", "f_prefix", "f_path_test", "f_path_config", "f_secret_word", "f_other_word", "f_assigned",
    "f_quoted",
)


def _share(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)) / F.length(text)


def _hint(text: Column, pattern: str) -> Column:
    return text.rlike(f"(?i){pattern}").cast("double")


def with_features(found: DataFrame) -> DataFrame:
    """Feature columns of ``candidate``, ``left``, ``right`` and ``path``."""
    c, low = F.col("candidate"), F.lower("candidate")
    left, path = F.coalesce("left", F.lit("")), F.coalesce("path", F.lit(""))
    uncovered = F.length(F.regexp_replace(low, "|".join(sorted(DICTIONARY, key=len, reverse=True)), ""))
    made = {
        "f_length": F.least(F.length(c), F.lit(200)).cast("double"),
        "f_digits": _share(c, "[0-9]"),
        "f_distinct": F.size(F.array_distinct(F.split(c, ""))) / F.least(F.length(c), F.lit(64)),
        "f_letter_digit": _share(c, "[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])"),
        "f_case": _share(c, "[a-z](?=[A-Z])|[A-Z](?=[a-z])"),
        "f_clusters": _share(low, "[bcdfghjklmnpqrstvwxz]{4}"),
        "f_vowels": _share(low, "[aeiou]"),
        "f_hex": c.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$").cast("double"),
        "f_parts": _share(c, r"[+/_=\-]"),
        "f_runs": _share(low, r"(.)\1\1"),
        "f_dictionary": 1 - uncovered / F.length(c),
        "f_prefix": c.rlike(f"^(?:{KEY_PREFIXES})").cast("double"),
        "f_path_test": _hint(path, TEST_PATH),
        "f_path_config": _hint(path, CONFIG_PATH),
        "f_secret_word": _hint(left, SECRET_WORDS),
        "f_other_word": _hint(left, f"(?:^|[^a-z])(?:{OTHER_WORDS})"),
        "f_assigned": left.rlike("(?:=>?|:=?)\\s*[\"'`]?\\s*$").cast("double"),
        "f_quoted": (left.rlike("[\"'`]$") & F.coalesce("right", F.lit("")).rlike("^[\"'`]")).cast("double"),
    }
    return found.select("*", *[made[name].alias(name) for name in FEATURES])


def made_findings(spark: SparkSession, rows: int = TRAINING_ROWS) -> DataFrame:
    """Labelled findings by rule: ``candidate``, ``left``, ``right``, ``path``, ``label``."""
    i = F.col("id")

    def digest(salt: str) -> Column:
        return F.sha2(F.concat(F.lit(salt), i.cast("string")), 512)

    def pick(salt: str, *values: str) -> Column:
        at = F.pmod(F.xxhash64(F.lit(salt), i), F.lit(len(values))) + 1
        return F.element_at(F.array(*[F.lit(v) for v in values]), at.cast("int"))

    def between(salt: str, low: int, high: int) -> Column:
        return (F.pmod(F.xxhash64(F.lit(salt), i), F.lit(high - low + 1)) + low).cast("int")

    base64 = F.regexp_replace(F.base64(F.unhex(digest("b"))), "[+/=]", "x")
    digits = F.regexp_replace(digest("d"), "[a-f]", "")
    hexa = F.when(between("u", 0, 3) == 0, F.upper(digest("h"))).otherwise(digest("h"))
    sep, parts = pick("sep", "_", "-", ""), [pick(f"w{k}", *DICTIONARY) for k in range(3)]
    name = F.concat(parts[0], sep, parts[1], sep, parts[2], sep, between("n", 1, 2030).cast("string"))
    secret_name = pick("sn", "token", "api_key", "secret", "password", "access_key", "auth_token", "client_secret", "TOKEN", "private key")
    assign = pick("as", " = ", ": ", "=", " := ", " => ")
    quote = pick("q", '"', "'", '"', "")
    lead = pick("lead", "", "and the ", "for user in ", "export ", "\n", "set ", "of that, ")
    told = F.concat(lead, secret_name, assign, quote)
    plain = F.concat(lead, pick("pl", "see ", "the ", "in ", "of ", "at ", "no. ", ""))
    path = pick("path", "config/app.yaml", "src/main.py", "deploy/.env", "source", "web", "", "lib/a.js")
    kinds = [
        (1, F.substring(hexa, 1, 40), told, quote),
        (1, F.substr(base64, F.lit(1), between("l", 20, 44)), told, quote),
        (1, F.concat(F.lit("AKIA"), F.upper(F.substring(base64, 1, 15)), F.lit("7")), F.concat(lead, quote), quote),
        (1, F.concat(pick("pre", "ghp_", "sk-", "xoxb-", "AIza", "eyJ"), F.substring(base64, 1, 34), F.lit("4")), plain, F.lit(" ")),
        (1, F.substr(hexa, F.lit(1), between("l2", 24, 64)), F.concat(lead, F.lit("Authorization: Bearer ")), F.lit("\n")),
        (1, F.concat(F.substring(base64, 1, 20), F.lit("9")), told, quote),
        (1, F.concat(F.substring(base64, 1, 6), pick("si", "&", "!", "#", "$", "@"), F.substr(digits, F.lit(1), between("l4", 1, 4))), told, quote),
        (1, F.substr(F.regexp_replace(base64, "[0-9]", "Q"), F.lit(1), between("l5", 16, 32)), told, quote),
        (0, pick("code", "getToken(request)", "os.environ", "response.data.token", "self.password", "required", "undefined", "config.secret", "function(data)", "process.env.TOKEN"), told, F.lit("\n")),
        (0, F.concat(parts[0], pick("cs", "_", ".", ""), parts[1], pick("ce", "", "()", "(name)")), told, quote),
        (0, F.substring(hexa, 1, 40), F.concat(plain, pick("cm", "commit ", "revision ", "sha1: ", "merge commit ")), F.lit(" ")),
        (0, F.substring(digest("h"), 1, 32), F.concat(plain, pick("md", "md5 ", "checksum: ", "digest=", "hash ")), F.lit("\n")),
        (0, F.concat_ws("-", *[F.substring(digest("h"), a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]),
         F.concat(plain, pick("uu", "uuid ", "id=", "request ", "")), F.lit(" ")),
        (0, F.concat(F.lit("1"), F.substr(digits, F.lit(1), between("l3", 15, 20))), plain, F.lit(" ")),
        (0, F.concat(name, F.lit("-"), pick("ext", "final1", "v2", "draft3", "0001")), F.concat(plain, pick("fi", "file ", "/", "")), F.lit(".")),
        (0, F.concat(F.repeat(pick("ph", "x", "0", "a", "1"), 18), F.lit("0")), told, quote),
        (0, F.concat(pick("ex", "EXAMPLE", "example-", "your-", "insert_"), F.upper(F.lit("key")), F.lit("-0123456789")), told, quote),
        (0, F.concat(F.lit("sha512-"), base64), F.concat(plain, F.lit('integrity="')), F.lit('"')),
        (0, F.concat(name, F.lit("_1")), told, quote),
        (0, F.concat(F.lit("2024-05-"), between("dd", 10, 28).cast("string"), F.lit("T10-20-30")), plain, F.lit(" ")),
    ]

    def chosen(at: int) -> Column:
        out = None
        for k, kind in enumerate(kinds):
            value = kind[at] if isinstance(kind[at], Column) else F.lit(kind[at])
            out = F.when(F.pmod(i, F.lit(len(kinds))) == k, value) if out is None else out.when(F.pmod(i, F.lit(len(kinds))) == k, value)
        return out

    return spark.range(rows).select(
        chosen(1).alias("candidate"), chosen(2).alias("left"), chosen(3).alias("right"), path.alias("path"), chosen(0).cast("double").alias("label")
    )


def train(findings: DataFrame) -> RandomForestClassificationModel:
    """A forest of labelled findings (``candidate``, ``left``, ``right``, ``path``, ``label``)."""
    rows = cut_lineage(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(with_features(findings)).select("features", "label"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.8)
    return forest.fit(rows)


def candidates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path_column: str | None = "source") -> DataFrame:
    """One row per candidate: id, ``start`` (characters before it), ``candidate``, ``left``, ``right``, ``path``."""
    text = whole_text(text_column)
    path = F.col(path_column).cast("string") if path_column else F.lit(None).cast("string")
    marked = F.regexp_replace(text, _NEXT_NAME, _MARK)
    taken = docs.select(
        F.col(id_column).alias("__id"),
        path.alias("path"),
        F.regexp_extract_all(marked, F.lit(CANDIDATE), F.lit(0)).alias("__found"),
        F.split(marked, CANDIDATE, -1).alias("__between"),
        F.monotonically_increasing_id().alias("__row"),
    ).where(F.size("__found") > 0)
    pairs = F.transform(
        "__found",
        lambda c, k: F.struct(
            c.alias("candidate"),
            F.length(F.element_at("__between", k + 1)).alias("gap"),
            F.right(F.element_at("__between", k + 1), F.lit(LEFT)).alias("left"),
            F.left(F.element_at("__between", k + 2), F.lit(RIGHT)).alias("right"),
        ),
    )
    rows = taken.select("__id", "__row", "path", F.posexplode(pairs).alias("__at", "__x")).select("__id", "__row", "path", "__at", "__x.*")
    before = Window.partitionBy("__row").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("gap") + F.length("candidate")).over(before), F.lit(0)) + F.col("gap")
    plain = [F.replace(c, F.lit(_MARK), F.lit("&")).alias(c) for c in ("candidate", "left", "right")]
    return rows.select(F.col("__id").alias(id_column), start.cast("bigint").alias("start"), *plain, "path")


def scan(
    docs: DataFrame,
    model: RandomForestClassificationModel | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    path_column: str | None = "source",
    limit: float = LIMIT,
) -> DataFrame:
    """Candidates with ``score`` (chance of a true secret) and ``secret`` (score at least ``limit``)."""
    model = model or train(made_findings(docs.sparkSession))
    found = candidates(docs, id_column, text_column, path_column)
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(with_features(found))
    scored = model.transform(assembled).withColumn("score", vector_to_array("probability")[1])
    return scored.select(*found.columns, "score", (F.col("score") >= limit).alias("secret"))
