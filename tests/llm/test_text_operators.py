"""Secrets, line windows, decontamination, language, and their edge cases."""

import base64
import hashlib
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from wayloom.llm import langid, linededup, queries, secretscan, winnow

EDGE = [(1, None, "x"), (2, "", "x"), (3, "  \n\t ", "x"), (None, "no id here", "x"), (4, "same text twice", "x"), (4, "same text twice", "x"), (5, "word " * 20000, "x")]


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls, empty and long texts, repeated rows; extra columns with clashing names."""
    cols = "doc_id long, text string, n_words string"
    return spark.createDataFrame(EDGE, cols).withColumn("fp", F.lit(1)).withColumn("words", F.lit("w")).withColumn("n", F.lit(2)).withColumn("id", F.lit("i")).withColumn("_t", F.lit(0)).withColumn("bucket", F.lit(0))


def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


# the contract's patterns, stated anew: nothing of the operator is used here
_SAFE = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")


def _assign_at(t, i):
    """The end of an assignment at a place, and the length of its value; by hand, without a pattern."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t[i : i + 8])
    word = next((w for w in ("password", "passwd", "secret", "token", "api_key", "apikey") if low.startswith(w)), None)
    if word is None:
        return None
    for quote in ((1, 0) if t[i + len(word) : i + len(word) + 1] in ("'", '"') else (0,)):
        j = i + len(word) + quote
        while t[j : j + 1] == " ":
            j += 1
        if t[j : j + 1] not in (":", "="):
            continue
        j += 1
        while t[j : j + 1] == " ":
            j += 1
        j += t[j : j + 1] in ("'", '"')
        k = j
        while t[k : k + 1] and t[k] in _SAFE:
            k += 1
        if k > j:
            return k, k - j
    return None


def _runs(t, letters, head=""):
    i, out = 0, []
    while i < len(t):
        if t.startswith(head, i) and t[i + len(head) : i + len(head) + 1] and t[i + len(head)] in letters:
            k = i + len(head)
            while k < len(t) and t[k] in letters:
                k += 1
            out.append((i, k))
            i = k
        else:
            i += 1
    return out


def brute_secrets(text):
    """The base counts and digest, read character by character."""
    t, a, i = text or "", [], 0
    while i < len(t):
        if found := _assign_at(t, i):
            if found[1] >= 6:
                a.append(("assign", i, found[0]))
            i = found[0]
        else:
            i += 1
    b = [("access", x, y) for x, y in _runs(t, set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), "AKIA") if y - x >= 20]
    c = [("hex", x, y) for x, y in _runs(t, set("0123456789abcdef")) if y - x >= 24]
    spans = sorted(a + b + c, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))
    return len(a), len(b), len(c), hashlib.sha256(",".join(f"{k}:{x}:{y}" for k, x, y in spans).encode()).hexdigest()


def test_base_secrets_match_the_patterns(spark):
    texts = {r["doc_id"]: r["text"] for r in documents(spark).collect()}
    extra = ["password=token:abcdefgh", "API-key api_key : 'abc123XYZ', apikey=\"short\"", "AKIA" + "A" * 15, "AKIA" + "A" * 16, "f" * 23, "f" * 24 + "g" + "0" * 30, "ſecret=abcdefg", "x PASSWD=ab.cd/ef== y", "secret= token=abcdef"]
    for t in [*texts.values(), *extra, None, ""]:
        spans = secretscan.scan(t) if t else []
        base = [s for s in spans if s[0] != "literal"]
        a, b, c, sha = brute_secrets(t)
        assert [sum(s[0] == k for s in base) for k in ("assign", "access", "hex")] == [a, b, c]
        assert hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest() == sha
    got = {r["doc_id"]: (r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in queries.op2_assignment_secrets(spark, str(DATA)).collect()}
    assert got == {i: brute_secrets(t) for i, t in texts.items()}


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ('db_pwd := "Zx9#kLm2Qp"', "Zx9#kLm2Qp"), ("{'clientSecret': 'Zx9kLm2Qp77'}", "Zx9kLm2Qp77"), ('k = "Qw8eRt5yUi"\npassphrase = k', "Qw8eRt5yUi"),
        ('part = "Qw8eRt5y"\nauthToken = part + "Zz01"', "Qw8eRt5y"), ("export DB_PWD=Zx9kLm2Qp", "Zx9kLm2Qp"), ("cfg['x'] = 1\naccess_key => 'Zx9kLm2Qp5'", "Zx9kLm2Qp5"),
    ],
)
def test_literals_of_sensitive_names(text, value):
    assert value in [text[a:b] for k, a, b in secretscan.scan(text) if k == "literal"]


@pytest.mark.parametrize("text", ['name = "Zx9kLm2Qp"', 'password_length = "Zx9kLm2Qp5"', 'secret_pwd = "changeme"', 'if pwd == "Zx9kLm2Qp": pass', "the key: a word", 'token_type = "bearer"'])
def test_other_literals_stay_unreported(text):
    assert not [s for s in secretscan.scan(text) if s[0] == "literal"]


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ('config["password"] = "hunter2-X9"', "hunter2-X9"), ("os.environ['SECRET_TOKEN'] = 'ab12cd34'", "ab12cd34"), ('password: str = "abcd1234"', "abcd1234"),
        ('c[0]["db"]["password"] = "Zx9kLm2Qp5"', "Zx9kLm2Qp5"), ("x[" + "a" * 80 + ']["pwd"] = "Zx9kLm2Qp5"', "Zx9kLm2Qp5"), ('secret["a"] = "Zx9kLm2Qp5"', "Zx9kLm2Qp5"),
        ('def f(a, password: Optional[dict[str, str]] | None = "Zx9kLm2Qp5"):', "Zx9kLm2Qp5"), ("let pwd: &'static str = \"Zx9kLm2Qp5\";", "Zx9kLm2Qp5"), ('k = "Qw8eRt5yUi"\npwd: str = k', "Qw8eRt5yUi"),
        ('note: pwd = "Zx9kLm2Qp5"', "Zx9kLm2Qp5"), ('cfg["a"] = "Qw8eRt5yUi"\npassphrase = cfg["a"]', "Qw8eRt5yUi"),
    ],
)
def test_subscripted_and_typed_targets(text, value):
    assert value in [text[a:b] for k, a, b in secretscan.scan(text) if k == "literal"]


@pytest.mark.parametrize("text", ['config["title"] = "Zx9kLm2Qp5"', 'password["length"] = "Zx9kLm2Qp5"', 'title: str = "Zx9kLm2Qp5"', 'pwd: str == "Zx9kLm2Qp5"'])
def test_other_targets_stay_unreported(text):
    assert not [s for s in secretscan.scan(text) if s[0] == "literal"]


def test_long_runs_of_subscripts_are_linear():
    for text in ("a" + '["x"]' * 50000 + " :", "a[" * 50000 + "=", "a:b[" * 50000, "a:b<" * 50000, "a['" * 50000 + "="):
        start = time.process_time()
        secretscan.scan(text)
        assert time.process_time() - start < 10


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("<config><password>Zx9kLm2Qp5</password></config>", "Zx9kLm2Qp5"), ("define('DB_PASSWORD', 'Zx9kLm2Qp5');", "Zx9kLm2Qp5"), ('props.put("clientSecret", "Zx9kLm2Qp5")', "Zx9kLm2Qp5"),
        ('# pwd = "Zx9kLm2Qp5"', "Zx9kLm2Qp5"), ("// db.pwd = 'Zx9kLm2Qp5';", "Zx9kLm2Qp5"), ('a = pwd = "Zx9kLm2Qp5"', "Zx9kLm2Qp5"), ('pwd = a = "Zx9kLm2Qp5"', "Zx9kLm2Qp5"),
        ('pwd = b"Zx9kLm2Qp5"', "Zx9kLm2Qp5"), ('pwd = """Zx9k\nLm2Qp5"""', "Zx9k\nLm2Qp5"), ("pwd = `Zx9kLm2Qp5`", "Zx9kLm2Qp5"), ('pwd = "Zx9\\"kLm2Qp5"', 'Zx9\\"kLm2Qp5'), ('pwd = "Zx9k" "Lm2Qp5"', "Lm2Qp5"),
        ('dsn = "Server=db1;Passphrase=Zx9kLm2Qp5"', "Zx9kLm2Qp5"), ("passphrase: |\n  Zx9kLm2Qp5\n  more9more9\nnext: 1", "Zx9kLm2Qp5"), ("DB_PWD=Zx9#kLm!2Qp5", "Zx9#kLm!2Qp5"),
        ('self.k = "Qw8eRt5yUi"\nself.pwd = self.k', "Qw8eRt5yUi"), ("don't say: pwd = 'Zx9kLm2Qp5', it isn't wise", "Zx9kLm2Qp5"), ('{"auth": {"bearer": "Zx9kLm2Qp5"}}', "Zx9kLm2Qp5"), ("db-passphrase: Zx9kLm2Qp5", "Zx9kLm2Qp5"),
    ],
)
def test_lexed_forms(text, value):
    assert value in [text[a:b] for k, a, b in secretscan.scan(text) if k == "literal"]


@pytest.mark.parametrize(
    "text",
    [
        'pwd = os.getenv("SECRET_TOKEN_9")', 'pwd = read_secret("Zx9kLm2Qp5")', 'if x {\n  k = "Qw8eRt5yUi"\n}\npwd = k', 'def f():\n    k = "Qw8eRt5yUi"\ndef g():\n    pass\npwd = k', "<title>Zx9kLm2Qp5</title>",
        "put('title', 'Zx9kLm2Qp5')", "pwd: the word is not here", 'x = "pwd"\ny = "Zx9kLm2Qp5"', 'pwd === "Zx9kLm2Qp5"', 'pwd != "Zx9kLm2Qp5"',
    ],
)
def test_forms_that_are_no_secret(text):
    assert not [s for s in secretscan.scan(text) if s[0] == "literal"]


@pytest.mark.parametrize(
    "piece",
    ["a", "ab_c.", "a-", "f0", "word ", '"', "'", "`", '"""', "<a>", "<a x", "x=", "x:", "a['", 'a["x"]', "{a=1", "a.b", "=", "(", "\\", 'x: 1\n', '"a', "b'x", "k = 'v1'\n", "+", "|\n ", "a, "],
)
def test_scan_time_is_linear(piece):
    def took(n):
        text = "x: 1\n" + piece * (n // len(piece)) + " :"
        start = time.process_time()
        secretscan.scan(text)
        return time.process_time() - start

    took(1000)
    assert took(400_000) < 12 * max(took(50_000), 0.02)


def test_a_long_run_is_read_once():
    start = time.process_time()
    secretscan.scan("x: 1\n" + base64.b64encode(random.Random(1).randbytes(7_500_000)).decode() + "\npwd = 'Zx9kLm2Qp5'")
    assert time.process_time() - start < 20


def test_secrets_edges(spark, edge):
    assert secretscan.digest(secretscan.secrets(edge)).count() == len(EDGE)


def brute_lines(rows, window=3):
    seen, out = set(), {}
    for i, t in sorted(rows):
        lines = t.split("\n")
        gone = set()
        for p in range(len(lines) - window + 1):
            w = tuple(lines[p : p + window])
            if any(x.strip(" ") for x in w):
                if w in seen:
                    gone |= set(range(p, p + window))
                seen.add(w)
        out[i] = (len(lines), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return out


def test_line_windows(spark):
    rows = [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\nd\ny"), (3, "a\nb"), (4, "\n\n\n\n"), (5, "r\nr\nr\nr\nr"), (6, "q\nb\nc\nd\nz")]
    got = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in got.collect()} == brute_lines(rows)
    real = [(r["doc_id"], r["text"]) for r in documents(spark).collect()]
    got = linededup.dedup_lines(documents(spark))
    assert {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in got.collect()} == brute_lines(real)


def test_line_edges(spark, edge):
    got = linededup.dedup_lines(edge)
    assert got.count() == len(EDGE) and got.where("doc_id = 1 and text is null and n_lines = 0").count() == 1
    assert linededup.dedup_lines(edge.where("false")).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute_contamination(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(13, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[p : p + n]), set()).add(str(i))
    sizes, out = {len(w) for w in windows}, []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for p in range(len(w) - n + 1):
                if s := windows.get(tuple(w[p : p + n])):
                    hit |= set(range(p, p + n))
                    found |= s
        out.append((i, len(w), len(hit), len(found), ",".join(sorted(found)), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def test_contamination_against_brute_force(spark):
    long = " ".join(f"w{i}" for i in range(30))
    items = [(1, long), (10, "Short Item-of five words"), (2, "ÀÉ ß Σας x"), (3, None), (4, "..."), (5, "alpha"), (6, " ".join(f"t{i}" for i in range(13)))]
    docs = [
        (1, "w0 " * 3 + long.upper() + " end"), (2, long[4:60] + " other"), (3, "say: short item, of FIVE words!"), (4, "àÉ ß σας x"), (5, "ÀÉ ß Σας X"), (6, None), (7, ""), (8, "Alpha beta alpha"),
        (9, " ".join(f"w{i}" for i in range(5, 17))), (10, "z " * 500 + " ".join(f"t{i}" for i in range(13))), (11, "t0 " + " ".join(f"t{i}" for i in range(13)) * 2), (8, "Alpha beta alpha"), (None, "alpha"),
    ]
    got = winnow.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    told = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], ",".join(r["items"]), r["contaminated"]) for r in got.collect()), key=str)
    assert told == brute_contamination(docs, items)


def test_contamination_of_real_documents(spark):
    got = queries.op6_winnowing_decontamination(spark, str(DATA)).collect()
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    want = brute_contamination([(r["doc_id"], r["text"]) for r in documents(spark).collect()], items)
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got), key=str) == sorted(
        ((i, n, h, k, hashlib.sha256(s.encode()).hexdigest(), c) for i, n, h, k, s, c in want), key=str
    )


def test_contamination_edges(spark, edge):
    none = spark.createDataFrame([], "item_id long, text string")
    got = winnow.contamination(edge, none)
    assert got.count() == len(EDGE) and got.where("contaminated").count() == 0
    some = spark.createDataFrame([(1, "word " * 15)], "item_id long, text string")
    assert sorted(r["n_hit"] for r in winnow.contamination(edge, some).where("contaminated").collect()) == [20000]
    left = winnow.drop_contaminated(edge, some)
    assert left.count() == len(EDGE) - 1 and left.columns == edge.columns
    assert winnow.contamination(edge.where("false"), some).count() == 0


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs.where(langid.fold() != 2))
    got = langid.identify(docs, model, keep=("lang",)).where(langid.fold() == 2)
    good, n = got.where("lang = lang_pred").count(), got.count()
    assert n > 200 and good / n > 0.93  # some labels are of another language than their text
    assert got.where("rejected").count() <= 1
    again = langid.train(docs.where(langid.fold() != 2).repartition(7))
    assert (again.centroids == model.centroids).all()


def test_language_edges(spark, edge):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.train(docs)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 34 !?"), (4, "日本"), (5, "the and of with"), (5, "the and of with")], "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(odd, model).collect()}
    assert [got[i][0] == "und" for i in (1, 2, 3, 4, 5)] == [True, True, True, False, False]
    assert langid.identify(edge, model, keep=("n_words", "fp")).count() == len(EDGE)
    nothing = langid.train(edge.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in langid.identify(edge, nothing).collect()} == {"und"}


def noise():
    """Texts of no training language: encoded bytes, unseen scripts, signs with a letter, in several lengths."""
    r = random.Random(3)
    russian = "Съешь же ещё этих мягких французских булок, да выпей чаю. Все люди рождаются свободными и равными в своём достоинстве и правах. "
    word = lambda letters: "".join(r.choice(letters) for _ in range(r.randint(2, 9)))
    out = ["Привет, как дела? Сегодня хорошая погода.", russian, russian * 5]
    for n in (100, 400, 2000):
        out += [base64.b64encode(r.randbytes(n)).decode(), r.randbytes(n).hex(), "a" + "".join(r.choice("0123456789") for _ in range(n))]
        out += [" ".join(word(x) for _ in range(n // 6)) for x in ("абвгдежзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρστυφχψω")]
        out += ["".join(chr(r.randrange(0x4E00, 0x9FA5)) for _ in range(n)), "".join(r.choice("!@#$%^&*()_+-=[]{}|;a") for _ in range(n))]
    return out


def test_language_rejects_noise_and_unseen_scripts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs.where(langid.fold() != 2))
    texts = noise()
    odd = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["rejected"] for r in langid.identify(odd, model).collect()}
    assert [texts[i][:40] for i in range(len(texts)) if not got[i]] == []
    held = langid.identify(docs.where(langid.fold() == 2), model)
    assert held.where("rejected").count() <= 0.01 * held.count()


def test_many_fingerprints_take_the_same_way(spark):
    r = random.Random(12)
    items = [(i, " ".join(f"w{r.randrange(10**6)}" for _ in range(400))) for i in range(320)]  # some 25,000 fingerprints
    docs = [(i, " ".join(f"v{r.randrange(10**6)}" for _ in range(60)) + " " + " ".join(items[i][1].split()[50 : 50 + 11 + i % 4])) for i in range(40)]
    got = winnow.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    told = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], ",".join(r["items"]), r["contaminated"]) for r in got.collect()), key=str)
    assert told == brute_contamination(docs, items) and sum(t[5] for t in told) == 20


def test_grams_of_long_texts_are_those_of_their_parts(monkeypatch):
    import numpy as np

    data = np.frombuffer(random.Random(4).randbytes(5000), np.uint8)
    offsets = np.array([0, 0, 1, 3, 1500, 1500, 5000])
    whole = langid.grams(data, offsets)
    monkeypatch.setattr(langid, "STEP", 7)
    assert (langid.grams(data, offsets) == whole).all()
    assert (langid._dense([langid._sparse(x) for x in whole]) == whole).all()


def test_labels_beyond_the_bound_are_left_out(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", 2)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("lang", F.when(F.col("doc_id") % 20 == 1, F.concat(F.lit("x"), "doc_id")).otherwise(F.col("lang")))
    assert len(set(langid.train(docs).langs)) == 2


@pytest.mark.parametrize("line", ["token = token + token\n", 'token = token + "y7"\n', 'a="b" + ', "a = a + a\n"])
def test_constants_that_grow(line):
    """Constants made of themselves: each line doubled the text, so fifty lines took all memory."""
    text = 'token = "9fK2mQ8xLpR4vT7w"\n' + line * 5_000
    began = time.time()
    found = [x for x in secretscan.scan(text) if x[0] == "literal"]
    assert time.time() - began < 20 and ("literal", 9, 25) in found
    if "y7" in line:
        assert len(found) == 5_001


def test_values_are_measured_as_their_texts_are():
    """Counts and short texts of nested values against the texts put together."""
    r = random.Random(8)
    for _ in range(300):
        made = [(secretscan.Value([], t, (0, 1)), t) for t in ("", "aB3$", "changeme", "hunter2-X9hunter2-X9")]
        for _ in range(r.randrange(1, 6)):
            some = [r.choice(made) for _ in range(r.randrange(1, 4))]
            made.append((secretscan.Value([v for v, _ in some]), "".join(t for _, t in some)))
        value, text = made[-1]
        value.measure()
        assert {c: k for c, k in value.counts.items()} == Counter(text)
        assert value.short == (text if len(text) <= secretscan.Value.SHORT else None)
