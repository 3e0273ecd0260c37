"""Surrogates: everything but the matches is unchanged; type, format, coreference and distinctness hold."""

import re

from pyspark.sql import functions as F

from parcelle.llm import surrogates

TEXT = ("Write to Jane.Doe7@mail.example.com or JANE.DOE7@MAIL.EXAMPLE.COM, call +1 (017) 555-7713 or +1 017 555 7713, pay 4539578763621486 "
        "or 4539 5787 6362 1486, from 97.51.17.173; token = \"ae93e105146691ae697923a219be4df655c4f1c7\". Mr. John Smith met Mrs. Anna Smith and Dr. Smith. "
        "IBAN DE89 3704 0044 0532 0130 00, SSN 123-45-6789. Госпожа Анна Иванова. Version 2.0, 1234 words, 12:30, a.b, x@y")


def rewritten(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: (r.text, r.n) for r in surrogates.pseudonymize(df, count_col="n").collect()}


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0


def mod97(s):
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


def test_types_formats_and_coreference(spark):
    out, n = rewritten(spark, [TEXT])[0]
    assert n == 14 and out != TEXT
    shape = lambda s: re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", s)))
    got = re.match(r"Write to (\S+) or (\S+), call (.+) or (.+), pay (\d{16}) or ((?:\d{4} ){3}\d{4}), from (\S+); token = \"(\w+)\"\. Mr\. (\w+) (\w+) met Mrs\. (\w+) (\w+) "
                   r"and Dr\. (\w+)\. IBAN (.+), SSN (.+)\. Госпожа (\w+) (\w+)\. (Version .*)$", out)
    mail, upper, a, b, card, spaced, ip, token, john, smith, anna, smith2, smith3, iban, ssn, given, last, rest = got.groups()
    assert rest == "Version 2.0, 1234 words, 12:30, a.b, x@y"
    assert mail.lower() == upper.lower() and upper == upper.upper() and shape(mail) == "Aaaa.Aaa9@aaaa.aaaaaaa.aaa" and mail.endswith(".com")
    assert shape(a) == "+9 (999) 999-9999" and shape(b) == "+9 999 999 9999" and re.sub(r"\D", "", a) == re.sub(r"\D", "", b)
    assert card == spaced.replace(" ", "") and luhn(card) and card != "4539578763621486" and card[0] == "4"
    assert all(0 < int(x) < 255 for x in ip.split(".")) and ip != "97.51.17.173"
    assert shape(token) == shape("ae93e105146691ae697923a219be4df655c4f1c7") and token != "ae93e105146691ae697923a219be4df655c4f1c7"
    assert smith == smith2 == smith3 != "Smith" and john != anna
    assert john in surrogates.GIVEN["latin"]["m"].split() and anna in surrogates.GIVEN["latin"]["f"].split()
    assert iban[:2] == "DE" and shape(iban) == "AA99 9999 9999 9999 9999 99" and mod97(iban) == 1
    assert shape(ssn) == "999-99-9999"
    assert given in surrogates.GIVEN["cyrillic"]["f"].split() and re.fullmatch(r"[А-Я][а-я]+", last) and last != "Иванова"


def test_distinct_values_stay_distinct_in_a_small_format(spark):
    values = [f"{a}{d}@x.io" for a in "abcdefghijklm" for d in range(10)]
    df = spark.createDataFrame([(v,) for v in values], "text string")
    table = surrogates.surrogate_table(df).collect()
    new = [r.replacement for r in table]
    assert len(table) == len(values) == len(set(new)) and not set(new) & set(values)
    names = spark.createDataFrame([(f"Mr. {n}a Smith",) for n in "Bo Co Do Fo Go Ho Jo Ko Lo Mo No Po Ro So To Vo Wo Xo Yo Zo Bu Cu Du".split()], "text string")
    assert len({r.replacement for r in surrogates.surrogate_table(names).collect()}) == 23


def test_clean_and_hostile_rows(spark):
    clean = ["Plain words, version 2.0 of 1999.", None, "", "1.2.3 and 1.2.3.4.5 and 12345", "x" * 100_000 + " " + "1 " * 50_000, "Mr. lower Frau und"]
    got = rewritten(spark, clean)
    assert [got[i] for i in range(len(clean))] == [(t, 0) for t in clean]
    df = spark.createDataFrame([(None, "a@b.org end", "k"), (None, "a@b.org end", "k"), (1, "10.0.0.1", None)], "doc_id long, text string, value string").withColumn("_m", F.lit(1))
    out = surrogates.pseudonymize(df)
    rows = out.collect()
    assert out.columns == df.columns and len(rows) == 3 and len({r.text for r in rows}) == 2 and all("a@b.org" not in r.text and r.text != "10.0.0.1" for r in rows)
    assert surrogates.pseudonymize(df.limit(0)).count() == 0


def test_no_planted_value_survives_and_the_rest_is_kept(spark):
    from conftest import SF_MID
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    out = {r.doc_id: r.text for r in surrogates.pseudonymize(docs).collect()}
    pat = re.compile(r"\S+@\S+\.\w+|\+\d \(\d{3}\) \d{3}-\d{4}|\b\d{16}\b|\b\d+\.\d+\.\d+\.\d+\b|\b[0-9a-f]{40}\b")
    seen = 0
    for r in docs.collect():
        found = pat.findall(r.text or "")
        seen += len(found)
        assert not any(f in out[r.doc_id] for f in found)
        if not found:
            assert out[r.doc_id] == r.text
    assert seen > 20


SECRETS = ["hunter", "s3cret", "Pa$$w0rd!", "correct horse battery", "eyJhbGci.eyJzdWIi.SflKxwRJ", "1234", "ae93e105146691ae697923a219be4df655c4f1c7", "p@ss", "ключ"]


def test_secrets_in_any_case_and_of_any_form(spark):
    names = ["TOKEN", "Password", "api_key", "Api-Key", "APIKEY", "secret"]
    texts = [f"start {n}{gap}{q}{v}{q} end." for v in SECRETS for n in names for gap in (" = ", ": ", "=") for q in ('"', "'", "") if q or " " not in v]
    texts += [f'{{"token": "{v}", "n": 1}}' for v in SECRETS]
    got = rewritten(spark, texts)
    for i, t in enumerate(texts):
        v = next(v for v in SECRETS if v in t)
        new, n = got[i]
        assert n == 1 and not any(x in new for x in re.findall(r"\w{4,}", v)) and v not in new, (t, new)
        a, b = t.split(v)
        assert new.startswith(a) and new.endswith(b), (t, new)
    clean = ["a token of love, the secret is out", "secret: ", 'password = ""', "token: ****", "tokens 5 = five"]
    assert [rewritten(spark, clean)[i] for i in range(len(clean))] == [(t, 0) for t in clean]


def test_names_to_their_end_and_bare_mentions(spark):
    cases = ["Mr McDonald", "Dr Anna Müller-Schmidt", "Dr John Paul Smith", "Mr O'Brien", "Mr. J. R. Smith", "Mrs. Jean-Marie d'Arc Leclerc", "Herr Ludwig van Beethoven",
             "Mr SMITH", "Prof. J.R.R. Tolkien", "Mr D’Angelo"]
    got = rewritten(spark, [f"then {c} spoke and left." for c in cases])
    for i, c in enumerate(cases):
        new, n = got[i]
        title = c.split()[0]
        assert n == 1 and new.startswith(f"then {title} ") and new.endswith(" spoke and left.")
        inner = new[len(f"then {title} "):-len(" spoke and left.")]
        assert len(inner.split()) == len(c.split()) - 1 and all(a != b or a == "van" for a, b in zip(inner.split(), c.split()[1:])), (c, new)
        assert not any(x in new for x in re.findall(r"[^\W\d_]{4,}", c) if x not in title), (c, new)
    text = "Smith was early. Mr John Smith's car and Mrs. Smith met; later Smith left, John too, SMITH said. Smithson and smith stay."
    new, n = rewritten(spark, [text])[0]
    m = re.fullmatch(r"(\w+) was early\. Mr (\w+) (\w+)'s car and Mrs\. (\w+) met; later (\w+) left, (\w+) too, (\w+) said\. Smithson and smith stay\.", new)
    a, john, b, c, d, john2, loud = m.groups()
    assert a == b == c == d != "Smith" and john == john2 != "John" and loud == a.upper() and n == 6
    assert rewritten(spark, ["Smith alone, John too, 5."])[0] == ("Smith alone, John too, 5.", 0)


def test_long_entities_do_not_overflow_the_stack(spark):
    n = 20_000
    long = ["x a@b" + ".b" * n + ".com y", "Dr. " + "A." * n + " Smith went", "Mr " + "von " * n + "Hagen"]
    df = spark.createDataFrame(list(enumerate(long)), "doc_id long, text string")
    found = [r.v for r in df.select(F.explode(surrogates.entities(F.col("text"))).alias("v")).collect()]
    assert sorted(len(v) for v in found) == sorted([len(long[0]) - 4, len(long[1]) - 5, len(long[2])])


def test_a_name_ends_before_ordinary_words(spark):
    title_case = "Mr Smith Said The Deal Is Done. The house is old, Said he, Deal or not."
    german = "Herr Weber Montag Abend im Haus. Am Montag kam der Abend."
    two = "Prof. Dr. Rajesh Baker came. A baker and a baker met; Baker left."
    follow = "Mr Jones Mr Miller and Mrs Jones Carter Walter Hunter Porter Cooper."
    got = {i: t for i, (t, _) in rewritten(spark, [title_case, german, two, follow]).items()}
    assert re.fullmatch(r"Mr (?!Smith)\w+ Said The Deal Is Done\. The house is old, Said he, Deal or not\.", got[0])
    assert re.fullmatch(r"Herr (?!Weber)\w+ Montag Abend im Haus\. Am Montag kam der Abend\.", got[1])
    assert re.fullmatch(r"Prof\. Dr\. (?!Rajesh)\w+ (?!Baker)\w+ came\. A baker and a baker met; Baker left\.", got[2])  # more often a trade than a name
    m = re.fullmatch(r"Mr (\w+) Mr (\w+) and Mrs (\w+) Carter Walter Hunter Porter Cooper\.", got[3])  # a run of six words
    assert m and m[1] == m[3] != "Jones" and m[2] != "Miller"


def test_rewrite_equals_plain_python(spark):
    """The given corpus with names planted: a plain reading of the docstring's rules gives the same places."""
    from conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    people = ["Herr Otto Kranz", "Mrs Lindqvist", "Dr. Anna Perlmann", "Mr Okafor"]
    hint = F.concat(F.element_at(F.array(*[F.lit(p) for p in people]), (F.col("doc_id") % 4 + 1).cast("int")), F.lit(" spoke here. "))
    planted = docs.withColumn("text", F.concat(hint, F.coalesce("text", F.lit(""))))
    base = {r.doc_id: r.text for r in surrogates.pseudonymize(docs.fillna("", ["text"])).collect()}
    table = {r.value: r.replacement for r in surrogates.surrogate_table(planted).collect()}
    out = {r.doc_id: r.text for r in surrogates.pseudonymize(planted).collect()}
    for d, text in out.items():
        p = people[d % 4]
        head = f"{table[p]} spoke here. "
        assert text.startswith(head) and table[p].split()[0] == p.split()[0] and not set(table[p].split()[1:]) & set(p.split()[1:])
        assert len(text) - len(head) == len(base[d]) or "@" in base[d] or any(c.isdigit() for c in base[d])
        if not re.search(r"[\d@]", base[d]):
            assert text[len(head):] == base[d]


def test_runs_of_name_words_are_linear(spark):
    n = 20_000
    letters = "abcdefghijklmnopqrst"
    word = lambda i: "X" + "".join(letters[int(c)] for c in str(i))
    text = "Mr Smith " + " ".join(word(i) for i in range(n)) + " went. Smith too."
    new, count = rewritten(spark, [text])[0]
    assert count == 2 and "Smith" not in new and new.split()[2:n + 2] == text.split()[2:n + 2]
