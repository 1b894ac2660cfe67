import re

from awkward import awkward, awkward_rows, empty, given

from marlstone.llm import secrets
from marlstone.llm.queries import QUERIES

PLANTED = re.compile(r'AKIA[A-Z0-9]{16}|(?<=token = ")[0-9a-f]{16,}|(?<=password=)[0-9a-f]{16,}')


def test_planted_secrets_are_found_and_nothing_else(spark):
    docs = dict(given("/root/testdata/sf0.01", "documents", "doc_id, text"))
    rows = QUERIES["op2_secret_scan"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(docs)
    for r in rows:
        expected = ",".join(f"{m.start()}:{m.end()}" for m in PLANTED.finditer(docs[r["doc_id"]] or ""))
        assert r["secrets"] == expected and r["n_secrets"] == len([x for x in expected.split(",") if x])


def test_candidates_match_brute_force(spark):
    texts = [t for (t,) in given("/root/testdata/sf0.01", "documents", "DISTINCT text")]
    expected = sorted(
        (m.start(), m.end(), m.group()) for t in texts for m in re.finditer(r"[A-Za-z0-9+/_-]{16,}={0,2}", t)
        if re.search("[0-9]", m.group()) or re.search(r"[a-z].*[A-Z]|[A-Z]{2}.*[a-z]", m.group()))
    got = secrets.candidates(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert sorted(tuple(r) for r in got.select("start", "end", "value").collect()) == expected


def test_words_around_a_candidate_come_from_the_text(spark):
    value = "wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY99"
    names = ["aws_secret_access_key", "stripe_live_secret_key", "github_personal_access_token", "password"]
    forms = ["{}={}", "{} = {}", '{}="{}"', '{} = "{}"', "{}: '{}'", "x1x1x1x1x1x1x1x1 {}={} 2y2y2y2y2y2y2y2y {}"]
    texts = [f"é {f.format(name, value, '')} end" for name in names for f in forms]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = secrets.with_features(secrets.candidates(df), secrets.dictionary(df)).collect()
    at = {(r["start"], r["before"], r["after"]) for r in found if r["value"] == value}
    assert at == {((i := t.index(value)), t[max(i - 48, 0):i], t[i + 40:i + 88]) for t in texts}
    for r in found:
        if r["value"] == value:
            assert r["named"] == r["assigned"] == 1
            assert r["quoted"] == (r["before"][-1] in "\"'")


def test_short_and_odd_values_after_a_name_are_candidates(spark):
    cases = [('db_password = "Tr0ub4dor9x" x', "Tr0ub4dor9x"), ("pwd: S3cr3t!2024, x", "S3cr3t!2024"),
             ("the password is hunter2x now", "hunter2x"), ("PASSWD=QWERTYUI", "QWERTYUI"),
             ("token='a$b%c&d'", "a$b%c&d"), ("aws_secret_access_key=p@ss/w0rd", "p@ss/w0rd"),
             ("api_key=" + "0af3" * 8, "0af3" * 8), ("password = kurz", None), ("a plain text: 12345678", None)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {(r["value"], r["start"]) for r in secrets.candidates(df).collect()}
    assert got == {(v, t.index(v)) for t, v in cases if v}


def planted(n):
    """True keys under a name, and look-alikes: paths, numbers, identifiers of plain words."""
    import random

    rng = random.Random(n)
    hexa = lambda k: "".join(rng.choices("0123456789abcdef", k=k))
    words = ["widget", "factory", "service", "handler", "manager", "account", "monitor", "cluster"]
    rows = []
    for i in range(n):
        a, b, c = rng.sample(words, 3)
        kind = i % 5
        text = {
            0: f'we set api_key = "{hexa(32)}" here',
            1: f"see https://host.example/{a}/{b}/{c}/{rng.randrange(10 ** 4)} for more",
            2: f"the {a.title()}{b.title()}{c.title()}Impl2 class of {a} {b} {c}",
            3: f"number 4{rng.randrange(10 ** 15):015d} printed",
            4: f"password: {hexa(24)} was used",
        }[kind]
        rows.append((i, f"{text} widget factory service handler manager account monitor cluster"))
    return rows


def test_forest_drops_look_alikes_on_held_out_texts(spark):
    def frame(rows):
        return spark.createDataFrame(rows, "doc_id long, text string")

    seen = secrets.with_features(secrets.candidates(frame(planted(400))), secrets.dictionary(frame(planted(400))))
    marked = seen.withColumn("label", (seen["value"].rlike("^[0-9a-f]{24,32}$")).cast("double"))
    model = secrets.train(marked)
    new = [(i + 1000, t.replace("widget", "gadget")) for i, t in planted(555)[401:]]
    rows = secrets.scan(frame(new), model=model).collect()
    true = {i for i, t in new if re.search(r'= "|password: ', t)}
    assert {r["id"] for r in rows if r["n_secrets"]} == true
    assert sum(r["n_candidates"] for r in rows) > len(true) * 2


def test_awkward_rows_and_empty_table(spark):
    rows = secrets.scan(awkward(spark)).collect()
    assert len(rows) == len(awkward_rows()) and all(r["n_secrets"] <= r["n_candidates"] for r in rows)
    assert secrets.scan(empty(spark)).count() == 0


def test_redaction(spark):
    df = spark.createDataFrame(
        [(1, "AKIA" + "Z9" * 8 + " é 1234567890123456 end", "x"), (2, None, "x"), (3, "plain", "x")],
        "doc_id long, text string, spans string")
    got = {r["doc_id"]: r["text"] for r in secrets.redact(df).collect()}
    assert got == {1: "[secret] é 1234567890123456 end", 2: None, 3: "plain"}


def test_plan_has_no_python(spark, sf_dir):
    plan = QUERIES["op2_secret_scan"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


PROBES = [
    ("SECRETARY: Johnson2 came", None), ("author: Jonathan Smith wrote", None),
    ("authenticated: 2024-01-02T10:00:00 by her", None), ("auth.example.com: https://auth.example.com/login/v2/x", None),
    ("see commit " + "0af3" * 10 + " today", None), ("the password is hunter2x now", "hunter2x"),
    ("key AKIA" + "Z9" * 8 + " was left", "AKIA" + "Z9" * 8), ("with ghp_" + "a1B2" * 9 + " in it", "ghp_" + "a1B2" * 9),
    ("xoxb-12345678901-abcDEF123456789", "xoxb-12345678901-abcDEF123456789"), ('db_password = "Tr0ub4dor9x"', "Tr0ub4dor9x"),
    ("password: required in this field", None), ("the token is undefined here", None),
    ("password_for_the_reporting_cluster = Geheim77x", "Geheim77x"), ("number 4929123412341234 printed", None),
]


def verdicts(df):
    texts = {i: t for i, (t, _) in enumerate(PROBES)}
    rows = secrets.scan(df).where("id between 0 and 99").collect()
    found = {r["id"]: [texts[r["id"]][int(a):int(b)] for a, b in (s.split(":") for s in r["secrets"].split(",") if s)]
             for r in rows if r["id"] in texts}
    return [found[i] for i in texts]


def test_verdicts_do_not_depend_on_the_rest_of_the_table(spark):
    alone = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(PROBES)], "doc_id long, text string")
    expected = [[value] if value else [] for _, value in PROBES]
    assert verdicts(alone) == expected
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").selectExpr("doc_id + 1000 AS doc_id", "text")
    assert verdicts(alone.unionByName(docs)) == expected


def test_every_form_is_judged_right_on_held_out_examples(spark):
    made = secrets.examples(spark, 1200, seed=99)
    judged = secrets.judged(secrets.labelled(made), secrets.default_model(spark)).collect()
    by_form = {}
    for r in judged:
        by_form.setdefault((r["form"], r["label"]), []).append((r["probability"] >= 0.5) == (r["label"] == 1.0))
    assert len(by_form) == 12
    for form, right in by_form.items():
        assert len(right) >= 80 and sum(right) >= 0.9 * len(right), form
    told = [r for r in judged if r["probability"] >= 0.5]
    for issued in ("issued", "named short", "named letters", "named hexadecimal", "loose letters"):
        assert all(r["label"] == 1.0 for r in told if r["form"] == issued)


def test_reviewed_findings_can_take_the_place_of_the_examples(spark):
    texts = [(i, f"the ticket {'AB' if i % 2 else 'XY'}{i:016d}Q of today") for i in range(200)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    found = secrets.with_features(secrets.candidates(df), secrets.dictionary(df))
    marked = found.withColumn("label", found["upper_share"] * 0 + found["value"].startswith("AB").cast("double"))
    assert secrets.train(marked.where("label = 1")) is None
    assert secrets.scan(df, model=secrets.train(marked)).count() == 200


def test_places_and_surroundings_of_many_matches(spark):
    import random

    rng = random.Random(8)
    parts = ["password=ab12cd34", "x", " ", "é𝄞", "A1" * 10, "token: 'zz99$$11'", "-", "," * 60, "word " * 12, "secret is aa11bb22"]
    texts = [" ".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pattern = re.compile(secrets.NAMED.replace("(?i:s?)", "[sS]?") + "|" + secrets.RUN.replace("}+", "}"))
    keys = {tuple(r)[1:]: r["doc_id"] for r in df.select("doc_id", *secrets.text_key(df["text"])).collect()}
    for r in secrets.candidates(df).collect():
        text = texts[keys[r["k1"], r["k2"]]]
        assert text[r["start"]:r["end"]] == r["value"]
        assert r["before"] == text[max(0, r["start"] - 48):r["start"]] and r["after"] == text[r["end"]:r["end"] + 48]
    total = sum(len({(m.start(1) if m.group(1) else m.start()) for m in pattern.finditer(t)}) for t in set(texts))
    assert secrets.candidates(df).count() == total


def test_each_pattern_walks_the_texts_once(spark):
    df = spark.createDataFrame([(1, "password=ab12cd34")], "doc_id long, text string")
    rows = df.select(*[c.alias(n) for c, n in zip(
        secrets.match_parts(df["text"], secrets.RUN), ("values", "pieces"), strict=True)])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1 and plan.count("split(") == 1
