r"""Secret scan: token-shaped candidates, and a random forest that drops the false ones.

A candidate is a run of 16 or more characters of [A-Za-z0-9+/_-] with up to two
'=' after it, with a digit or with letters of both cases (more than a capital at
its beginning); or 6 or more characters of any sort, without spaces and quotes,
right after a secret's name and '=', ':' or 'is'. The forest sees its
length, changes of character class, how much of it the corpus's dictionary
covers, whether it stands in a path, and the words around it. It is trained on
labelled findings of every form, true and false, that examples() makes by rule,
so the same candidate gets the same verdict whatever else a table holds; the
dictionary alone comes from the table. Built from DataFrame functions and the
DataFrame-based forest of Spark ML.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.spans import match_parts, spans_of, text_key
from marlstone.llm.storage import stored

RUN = r"[A-Za-z0-9+/_-]{16,}+={0,2}"
FEATURES = (
    "length", "changes", "digit_share", "upper_share", "kinds", "repeated", "covered", "in_path", "slashes",
    "assigned", "named", "quoted", "mail", "hexadecimal", "digested", "issued",
)
# A secret's name ends where its letters end, so that "secretary" and "author" are none.
NAME = (
    r"(?i:passw(?:or)?d|passwort|passphrase|pwd|secret|token|credential|bearer|auth|"
    r"(?:api|access|private|secret|auth|encryption|signing)[_-]?key)(?i:s?)(?![A-Za-z])")
NAME_ROOTS = ("passw", "passphrase", "pwd", "secret", "token", "credential", "bearer", "auth", "key")
GIVEN = r"[A-Za-z0-9_-]{0,64}[\"'`]?\s{0,4}(?:[=:]{1,2}>?|(?i:\bis\b))\s{0,4}[\"'`]?"
ASSIGNED = NAME + GIVEN
NAMED = rf"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{{0,64}}?{ASSIGNED}([^\s\"'`]{{5,}}[^\s\"'`.,;:)\]}}>])"
# Keys whose form names their issuer.
ISSUED = (
    r"^(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abps]-[0-9A-Za-z-]{10,}|"
    r"[sr]k_(?:live|test)_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35})$")
# Words before a value that is a digest or an identifier.
DIGEST_WORDS = (
    r"(?i)\b(?:commits?|revisions?|rev|sha-?\d*|md5|hash(?:es)?|digest|checksum|etag|uuid|guid|build|id|ref|"
    r"fingerprint)\W{0,4}$")
# Share of documents that a word must occur in to count as a dictionary word.
# With w different words in an average document, at most w / share words do.
DICTIONARY_SHARE = 0.001
# Labelled findings that the forest is trained on: the first so many of either label by hash.
SAMPLE_ROWS = 4000
EXAMPLES = 4800
TREES, DEPTH, SEED = 40, 8, 7
LEAST = 0.5

# Plain words of the examples, counted as dictionary words everywhere.
WORDS = (
    "account", "after", "before", "cluster", "config", "correct", "create", "default", "department", "example",
    "expired", "factory", "green", "handler", "horse", "invalid", "library", "manager", "market", "missing",
    "monitor", "number", "option", "orange", "parser", "person", "please", "product", "public", "reader", "record",
    "report", "required", "reset", "river", "sample", "schema", "server", "service", "simple", "station", "stored",
    "string", "summer", "system", "table", "thread", "undefined", "update", "user", "value", "version", "widget",
    "window", "winter", "writer", "your", "here", "key", "token", "password", "secret", "home", "local", "index")


def candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(k1, k2, n, start, end, value, before, after) per candidate of each distinct text.

    Every text is looked through once for its matches, whose parts are stored;
    places and surroundings come from these.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    low = F.lower("text")
    # names are looked for only where the letters of one stand
    some = F.lit(False)
    for root in NAME_ROOTS:
        some = some | low.contains(root)
    rows = docs.select(text.alias("text")).select(
        "text", (some & F.col("text").rlike(ASSIGNED)).alias("names")).where(
        F.col("names") | F.col("text").rlike(r"[A-Za-z0-9+/_-]{16}"))
    values, pieces = match_parts(F.col("text"), F.when(F.col("names"), f"{NAMED}|{RUN}").otherwise(RUN))
    found = stored(rows.select(
        *text_key(F.col("text")), values.alias("values"), pieces.alias("pieces")), "secret-matches")

    def value_of(span: Column) -> Column:
        # of a match that begins with a name, what was given to it
        given = F.regexp_extract(span["value"], f"^{NAMED}$", 1)
        ahead = F.char_length(span["value"]) - F.char_length(given)
        inside = F.struct(
            (span["start"] + ahead).alias("start"), span["end"].alias("end"), given.alias("value"),
            F.right(F.concat(span["before"], F.left(span["value"], ahead)), F.lit(48)).alias("before"),
            span["after"].alias("after"))
        return F.when(given == "", span).otherwise(inside)

    likely = F.filter(
        F.transform(spans_of(F.col("values"), F.col("pieces")), value_of),
        lambda s: s["value"].rlike("[0-9]") | s["value"].rlike(r"[a-z].*[A-Z]|[A-Z]{2}.*[a-z]") | s["before"].rlike(
            ASSIGNED + "$"))
    return found.dropDuplicates(["k1", "k2"]).select(
        "k1", "k2", F.posexplode(likely).alias("n", "s")).select("k1", "k2", "n", "s.*")


def dictionary(docs: DataFrame, text_col: str = "text", share: float = DICTIONARY_SHARE) -> DataFrame:
    """Words of three and more letters that a given share of all documents hold, and those of the examples."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.array_distinct(F.filter(F.split(F.lower(text), r"[^a-z]+"), lambda w: F.length(w) > 2))
    rows = docs.select(words.alias("words"))
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    counts = rows.select(F.explode("words").alias("word")).groupBy("word").count()
    common = counts.crossJoin(F.broadcast(total)).where(  # one row
        (F.col("count") >= 2) & (F.col("count") >= share * F.col("total"))).select("word")
    return common.unionByName(plain_words(docs.sparkSession)).distinct()


def plain_words(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*[F.lit(w) for w in WORDS])).alias("word"))


def _classes(value: Column) -> Column:
    lower = F.regexp_replace(value, "[a-z]", "a")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(lower, "[A-Z]", "B"), "[0-9]", "1"), "[^aB1]", "_")


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates with a number for each of FEATURES."""
    value, before, after = F.col("value"), F.col("before"), F.col("after")
    size = F.char_length(value)
    classes = _classes(value)
    runs = F.char_length(F.regexp_replace(classes, r"(.)\1+", "$1"))

    def share(pattern: str) -> Column:
        return F.char_length(F.regexp_replace(value, pattern, "")) / size

    own = found.withColumns({
        "length": size.cast("double"), "changes": (runs - 1) / size, "digit_share": share("[^0-9]"),
        "upper_share": share("[^A-Z]"), "kinds": F.size(F.array_distinct(F.split(classes, ""))).cast("double"),
        "repeated": 1 - F.size(F.array_distinct(F.split(value, ""))) / size,
        "in_path": before.rlike(r"(?:://|www\.|[\w~.]/)\S*$").cast("double"),
        "slashes": F.char_length(F.regexp_replace(value, "[^/]", "")).cast("double"),
        "assigned": before.rlike(r"""[=:]\s*["'`]?$""").cast("double"),
        "named": before.rlike(NAME + r"\S{0,64}\s{0,4}(?:[=:]{1,2}>?|is\b)?\s{0,4}[\"'`]?$").cast("double"),
        "quoted": (before.rlike("[\"'`]$") & after.rlike("^[\"'`]")).cast("double"),
        "mail": (after.startswith("@") | before.endswith("@")).cast("double"),
        "hexadecimal": value.rlike("^(?:[0-9a-f-]+|[0-9A-F-]+)$").cast("double"),
        "digested": before.rlike(DIGEST_WORDS).cast("double"), "issued": value.rlike(ISSUED).cast("double"),
    })
    parts = F.filter(F.split(F.lower(value), "[^a-z]+"), lambda w: F.length(w) > 2)
    known = found.select("k1", "k2", "n", F.explode(parts).alias("word")).join(words, "word").groupBy(
        "k1", "k2", "n").agg(F.sum(F.length("word")).alias("known"))
    return own.join(known, ["k1", "k2", "n"], "left").withColumn(
        "covered", F.coalesce(F.col("known") / F.col("length"), F.lit(0.0))).drop("known")


def _drawn(spark: SparkSession, rows: int, seed: int) -> DataFrame:
    """Row numbers with what the forms are made of, all from hashes of the number; stored."""
    def drawn(k: int | str) -> Column:
        return F.xxhash64(F.lit(seed), F.lit(k), "id")

    base = spark.range(0, rows, 1, 1).select(
        "id", *[drawn(k).alias(f"draw{k}") for k in range(10)],
        *[F.element_at(F.array(*[F.lit(w) for w in WORDS]), F.pmod(drawn(10 + k), F.lit(len(WORDS))).cast("int") + 1)
          .alias(f"word{k}") for k in range(6)],
        F.sha2(F.concat_ws("|", F.lit(seed), "id"), 256).alias("digits"),
        F.sha2(F.concat_ws("|", F.lit(seed), "id", F.lit("b")), 256).alias("other"),
        F.concat(F.abs(drawn("n")).cast("string"), F.lit("12345678")).alias("numbers"))
    return stored(base.withColumn("letters", F.translate(
        F.concat(F.base64(F.unhex("digits")), F.base64(F.unhex("other"))), "+/=\r\n", "")), "secret-draws")


def _forms() -> dict[str, tuple[float, Column, list[Column]]]:
    """Form by form: the label, a value, and the texts around it ('{}' is the value), over _drawn()."""
    def draw(k: int, n: int) -> Column:
        return F.pmod(F.col(f"draw{k}"), F.lit(n)).cast("int")

    def one_of(k: int, *choices: str | Column) -> Column:
        return F.element_at(F.array(*[F.lit(c) for c in choices]), draw(k, len(choices)) + 1)

    digits, other, letters, numbers = (F.col(c) for c in ("digits", "other", "letters", "numbers"))
    word = [F.col(f"word{k}") for k in range(6)]
    title = [F.initcap(w) for w in word]

    def cut(value: Column, least: int, most: int, k: int = 1) -> Column:
        return F.substring(value, F.lit(1), F.lit(least) + draw(k, most - least + 1))

    def formed(*parts: str | Column) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    name = one_of(
        2, "password", "passwd", "PWD", "db_password", "secret", "client_secret", "api_key", "apiKey", "access_token",
        "token", "TOKEN", "aws_secret_access_key", "auth_token", "private_key", "API_KEY", "stripe_live_secret_key",
        "passphrase", "github_personal_access_token", "encryption-key", "password_for_the_reporting_cluster")
    given = [
        formed(name, "={}"), formed(name, ' = "{}"'), formed(name, ": '{}'"), formed(name, ": {} and more"),
        formed("the ", name, " is {} now"), formed('{"', name, '": "{}", "', word[0], '": 1}'), formed(name, "='{}';"),
        formed("export ", name, "={}"), formed(word[1], " ", name, ' = "{}" ', word[2]), formed(name, " := {}")]
    plain = [formed(word[1], " {} ", word[2]), formed("{}"), formed("(", word[2], ", {})"), formed(word[0], " | {} | ", word[3]),
             formed('"{}"'), formed(title[1], "!! {}!! ", word[2])]
    issued = one_of(
        3, formed("AKIA", F.upper(cut(letters, 16, 16))), formed("ghp_", cut(letters, 36, 36)),
        formed("xoxb-", F.substring(numbers, 1, 11), "-", cut(letters, 20, 24)), formed("sk_live_", cut(letters, 24, 24)),
        formed("AIza", cut(letters, 35, 35)), formed("gho_", cut(letters, 36, 36)))
    short = one_of(
        4, formed(title[0], F.substring(numbers, 1, 3), "!"), formed(word[0], F.substring(numbers, 2, 2), "x"),
        formed(cut(letters, 3, 8), "$", F.substring(numbers, 1, 2), cut(other, 2, 4)), formed(cut(letters, 8, 14), "7"),
        formed("p@", cut(letters, 3, 6), "/", word[1], "0"), formed(title[0], "_", title[1], F.substring(numbers, 4, 2)),
        formed(F.regexp_replace(F.translate(title[2], "aeio", "4310"), "$", "9x")), formed(cut(digits, 6, 12), "#"))
    camel = one_of(
        5, formed(title[0], title[1], title[2], "Impl", F.substring(numbers, 1, 1)), formed(word[0], title[1], title[2], title[3]),
        formed(word[0], "_", word[1], "_", word[2], F.substring(numbers, 1, 2)),
        formed(word[0], "-", word[1], "-", word[2], "-", F.substring(numbers, 1, 4)),
        formed(title[0], title[1], title[2], title[3], "Test"), formed(F.upper(word[0]), "_", F.upper(word[1]), "_V2_", word[2]))
    path = one_of(
        6, formed(word[0], "/", word[1], "/", word[2], "/", F.substring(numbers, 1, 4)),
        formed("usr/", word[0], "/lib/", word[1], "3/", word[2]), formed(word[0], "/", title[1], title[2], "/v2/", cut(digits, 6, 10)))
    code = F.regexp_replace(digits, r"^(.{8})(.{4})(.{4})(.{4})(.{12}).*$", "$1-$2-$3-$4-$5")
    number = one_of(
        7, F.substring(numbers, 1, 16), F.concat(F.lit("4"), F.substring(numbers, 1, 15)), F.substring(numbers, 1, 19),
        formed("2024-0", F.substring(numbers, 1, 1), "-12-10-", F.substring(numbers, 2, 2), "-00"))
    said = one_of(
        8, word[4], formed(word[4], "-", word[5]), formed("your-", word[4], "-here"), formed("<", word[4], "_", word[5], ">"),
        formed("get", title[4], "()"), formed("${", F.upper(word[4]), "}"), "********", "undefined", "required",
        formed("https://", word[4], ".example.com/", word[5]), formed("/home/", word[4], "/", word[5]), "expired,", "incorrect",
        formed(word[4], ".", word[5], ".", word[0]))
    return {
        "issued": (1.0, issued, [*plain, *given[:3]]),
        "named hexadecimal": (1.0, one_of(9, cut(digits, 16, 64), F.upper(cut(digits, 16, 64)), cut(digits, 32, 32),
                                          cut(digits, 40, 40)), given),
        "named letters": (1.0, cut(letters, 16, 64), given),
        "named short": (1.0, short, given),
        "loose letters": (1.0, cut(letters, 32, 64), plain),
        "digest": (0.0, one_of(9, cut(digits, 32, 32), cut(digits, 40, 40), digits, code), [
            formed("see commit {} today"), formed("sha256: {}"), formed("md5 {}"), formed("revision {} of ", word[0]),
            formed("checksum={}"), formed("uuid {}"), formed('"id": "{}"'), formed("build {}"), formed("etag: \"{}\"")]),
        "loose hexadecimal": (0.0, one_of(9, cut(digits, 32, 32), cut(digits, 40, 40), digits, code), plain),
        "number": (0.0, number, [*plain, formed("order {} ", word[0]), formed(title[0], ": {}")]),
        "identifier": (0.0, camel, [*plain, formed("the {} class of ", word[0]), formed("import {};"), formed(word[0], " = {}")]),
        "path": (0.0, path, [formed("see https://host.example/{} for"), formed("in /{} now"), formed("~/{}"),
                             formed("www.", word[3], ".example/{}"), formed("open ./{}")]),
        "said of a name": (0.0, said, given[:8]),
        "mail": (0.0, formed(word[0], ".", cut(digits, 10, 14), "-", word[1]), [formed("write to {}@mail.example.org"), formed(
            "{}@example.com")]),
    }


def examples(spark: SparkSession, rows: int = EXAMPLES, seed: int = SEED) -> DataFrame:
    """(id, form, text, value, label): texts with one finding each, as many of every form, by rule.

    Values come from hashes of the row number, so the same call gives the same
    texts everywhere.
    """
    forms, drawn = _forms(), _drawn(spark, rows, seed)
    parts = []
    for place, (form, (label, value, texts)) in enumerate(forms.items()):
        own = drawn.where(F.col("id") % len(forms) == place)
        around = F.element_at(F.array(*texts), F.pmod("draw0", F.lit(len(texts))).cast("int") + 1)
        parts.append(own.select("id", F.lit(form).alias("form"), around.alias("around"), value.alias("value"),
                                F.lit(label).alias("label")))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return stored(whole.select(
        "id", "form", F.replace("around", F.lit("{}"), F.col("value")).alias("text"), "value", "label"), "secret-examples")


def labelled(made: DataFrame) -> DataFrame:
    """Findings of examples, with their features and label.

    Reviewed findings with the columns of with_features() and a label can take
    the place of these, or be added to them.
    """
    spark = made.sparkSession
    found = with_features(candidates(made), plain_words(spark))
    keyed = made.select(*text_key(F.col("text")), F.col("value").alias("planted"), "label", "form").dropDuplicates(["k1", "k2"])
    # a mark around a value may be part of the finding, or not; a mail address is found in part
    return found.join(keyed, ["k1", "k2"]).where(
        F.col("planted").contains(F.col("value")) | F.col("value").contains(F.col("planted"))).drop("planted")


def default_model(spark: SparkSession) -> RandomForestClassificationModel:
    """The forest of the examples: the same for every table."""
    return train(labelled(examples(spark)))


def _vectors(found: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(found)


def train(findings: DataFrame, sample_rows: int = SAMPLE_ROWS) -> RandomForestClassificationModel | None:
    """A forest from labelled findings; None unless both labels occur.

    The sample is bounded and in a fixed order in one partition, so that the
    same findings give the same forest.
    """
    order = F.xxhash64("value", "before", "label")
    parts = [findings.where(F.col("label") == label).orderBy(order, "value", "before", "start").limit(sample_rows)
             for label in (0.0, 1.0)]
    sample = stored(_vectors(parts[0].unionByName(parts[1])).select("label", "features", "value", "before").coalesce(1)
                    .sortWithinPartitions(F.xxhash64("value", "before"), "label"), "secret-sample")
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt")
    return forest.fit(sample.coalesce(1).select("label", "features"))


def judged(found: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """Candidates with the forest's probability; without a forest every candidate counts as true."""
    if model is None:
        return found.withColumn("probability", F.lit(1.0))
    scored = model.transform(_vectors(found))
    drop = ("features", "rawPrediction", "prediction")
    return scored.withColumn("probability", vector_to_array("probability")[1]).drop(*drop)


def findings(docs: DataFrame, text_col: str = "text", model: RandomForestClassificationModel | None = None) -> DataFrame:
    """Judged candidates of every distinct text, by the forest of the examples unless given one."""
    found = stored(candidates(docs, text_col), "secret-candidates")  # both of its uses read it stored
    featured = with_features(found, stored(dictionary(docs, text_col), "secret-dictionary"))
    return judged(featured, model or default_model(docs.sparkSession))


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST,
    model: RandomForestClassificationModel | None = None,
) -> DataFrame:
    """Per row of ``docs``: id, n_candidates, n_secrets, secrets as start:end, comma-joined.

    Null and empty texts have none. Ids may repeat or be null; equal texts get
    equal results; an empty table gives no rows; other columns are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    true = F.col("probability") >= least
    summary = findings(docs, text_col, model).groupBy("k1", "k2").agg(
        F.count(F.lit(1)).alias("n_candidates"), F.sum(true.cast("bigint")).alias("n_secrets"),
        F.sort_array(F.collect_list(F.when(true, F.struct("start", "end")))).alias("spans"))
    rows = docs.select(F.col(id_col).alias("id"), *text_key(text))
    return rows.join(summary, ["k1", "k2"], "left").select(
        "id", F.coalesce("n_candidates", F.lit(0).cast("bigint")).alias("n_candidates"),
        F.coalesce("n_secrets", F.lit(0).cast("bigint")).alias("n_secrets"),
        F.coalesce(F.array_join(F.transform("spans", lambda s: F.concat_ws(
            ":", s["start"].cast("string"), s["end"].cast("string"))), ","), F.lit("")).alias("secrets"))


def redact(docs: DataFrame, text_col: str = "text", least: float = LEAST, put: str = "[secret]") -> DataFrame:
    """``docs`` with every secret replaced; all columns stay.

    Rows are told apart by their texts, so null and repeated ids make no
    difference; null texts stay null. No column may be named __k1, __k2 or __spans.
    """
    spans = findings(docs, text_col).where(F.col("probability") >= least).groupBy("k1", "k2").agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__spans")).select(
        F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), "__spans")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    k1, k2 = text_key(text)
    joined = docs.join(spans, (k1 == F.col("__k1")) & (k2 == F.col("__k2")), "left")
    done = F.aggregate(
        "__spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(s["end"].alias("at"), F.concat(
            acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(put)).alias("out")))
    rest = F.substring(text, done["at"] + 1, F.char_length(text))
    return joined.withColumn(text_col, F.when(F.col("__spans").isNull(), F.col(text_col)).otherwise(
        F.concat(done["out"], rest))).select(*docs.columns)
