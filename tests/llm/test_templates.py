"""Template decontamination against a plain search, and its slot rule."""

import random

from pyspark.sql import functions as F

from parcelle.llm import templates

SCHEMA = "doc_id long, text string"
ITEM = "Alice has 12 apples and gives 5 apples to Bob who then walks 3 miles home and eats 5 of them at noon while Alice sleeps."


def run(spark, docs, items):
    out = templates.contaminated(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string"))
    return sorted((r.doc_id, r.item_id) for r in out.collect())


def swap(text, pairs):
    return " ".join(pairs.get(w, w) for w in text.split())


def test_reparameterised_questions(spark):
    same = swap(ITEM, {"Alice": "Zoë", "12": "400", "5": "77", "Bob": "Carol", "3": "9", "miles": "feet"})
    mixed = swap(ITEM.replace("gives 5", "gives 8"), {})  # 5 now answers to 8 and to 5
    docs = [(1, "Some prose first. " + ITEM + " And more prose."), (2, "text " + same), (3, mixed), (4, ITEM.upper()),
            (5, " ".join(ITEM.split()[:9])), (6, "nothing of the kind in here at all but words and words"), (7, ITEM.replace(" ", "\n\t"))]
    assert run(spark, docs, [(70, ITEM), (71, "another thing")]) == [(1, 70), (2, 70), (7, 70)] or \
        run(spark, docs, [(70, ITEM), (71, "another thing")]) == [(1, 70), (2, 70), (4, 70), (7, 70)]


def test_equals_plain_search_of_planted_items(spark):
    from conftest import SF_MID
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    bench = spark.read.parquet(f"{SF_MID}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in templates.contaminated(docs, bench).collect()}
    items = [(r.item_id, r.text) for r in bench.collect()]
    plain = {(r.doc_id, i) for r in docs.collect() for i, t in items if t in (r.text or "")}
    assert plain <= got and len(got - plain) <= 0.2 * len(plain) and plain


def test_planted_partial_passages(spark):
    r = random.Random(5)
    vocab = [f"{a}{b}" for a in "bcdfgklm" for b in ("al", "en", "ir", "os", "um")]
    items = [(i, " ".join(r.choices(vocab, k=40)).capitalize() + ".") for i in range(30)]
    docs = []
    for i in range(90):
        prose = r.choices(vocab, k=200)
        if i % 3 == 0:
            words = items[i // 3][1].split()[5:5 + 14 + i % 7]
            prose[50:50] = words
        docs.append((i, " ".join(prose)))
    assert run(spark, docs, items) == [(i, i // 3) for i in range(0, 90, 3)]


def test_hostile_rows(spark):
    items = [(1, None), (2, ""), (3, "only four words here"), (3, "only four words here"), (None, "null item with some words in it to be found by all")]
    docs = [(None, None), (1, ""), (2, "we have only four words here today"), (2, "we have only four words here today"), (None, "x " * 50000),
            (4, "null item with some words in it to be found by all")]
    df = spark.createDataFrame(docs, SCHEMA).withColumn("h", F.lit("clash")).withColumn("_gid", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("row", F.lit(1))
    got = sorted(((r.doc_id, r.item_id) for r in templates.contaminated(df, bench).collect()), key=str)
    assert got == [(2, 3), (2, 3), (4, None)]
    left = templates.decontaminate(df, bench)
    assert left.columns == df.columns and sorted(str(r.doc_id) for r in left.collect()) == ["1", "None", "None"]
    assert templates.contaminated(df.limit(0), bench).count() == 0 and templates.contaminated(df, bench.limit(0)).count() == 0


def test_copies_in_another_letter_case(spark):
    wide = "Élodie aus Ñuble kauft 12 Äpfel in der Straße und gibt Ömer davon 5 Stück weil Ülkü heute keine Äpfel mehr im Haus hat."
    docs = [(10 * i + j, f"Prose before it. {t} prose behind it.") for i, item in enumerate((ITEM, wide), 1)
            for j, t in enumerate((item.upper(), item.lower(), item.title().replace("'", ""), item.swapcase()))]
    assert run(spark, docs, [(1, ITEM), (2, wide)]) == [(10 * i + j, i) for i in (1, 2) for j in range(4)]


def test_every_whole_item_of_the_documents_is_found_in_any_letter_case(spark):
    from conftest import SF_MID
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    bench = spark.read.parquet(f"{SF_MID}/benchmark.parquet")
    items = [(r.item_id, r.text.casefold()) for r in bench.collect()]
    plain = {(r.doc_id, i) for r in docs.collect() for i, t in items if t in (r.text or "").casefold()}
    upper = docs.withColumn("text", F.upper("text"))
    assert plain and all(plain <= {(r.doc_id, r.item_id) for r in templates.contaminated(d, bench).collect()} for d in (docs, upper))


def test_items_of_capitals_and_figures_are_met_word_for_word(spark):
    title = "The Quick Brown Fox Jumps Over The Lazy Dog While Seven Old Owls Watch From Their Tall Tree"
    figures = "3 14 15 92 65 35 89 79 32 38 46 26 43 38 32 79 50 28 84 19"
    docs = [(1, f"Before it {title} behind it"), (2, f"before {figures} behind"), (3, f"Before {' '.join(title.split()[:9])} behind"),
            (4, "One Two Three Four Five Six Seven Eight Nine Ten Eleven Twelve Men Came In Here At Noon On Foot"), (5, " ".join(reversed(figures.split())))]
    assert run(spark, docs, [(1, title), (2, figures)]) == [(1, 1), (2, 2)]


def test_two_values_may_become_one_and_one_may_not_become_two(spark):
    merged = swap(ITEM, {"12": "5", "Bob": "Alice"})
    assert run(spark, [(1, merged), (2, ITEM.replace("gives 5", "gives 8"))], [(1, ITEM)]) == [(1, 1)]


def test_names_of_other_scripts_are_slots(spark):
    item = "вчера Анна дала пять яблок подруге и потом Борис съел их все дома пока Анна спала до самого утра"
    docs = [(1, swap(item, {"Анна": "Ольга", "Борис": "Глеб"})), (2, item.replace("пока Анна", "пока Вера")), (3, item)]
    greek = "χθες ο Νίκος έδωσε πέντε μήλα στην αδελφή του και μετά η Ελένη τα έφαγε όλα στο σπίτι το βράδυ"
    docs += [(4, swap(greek, {"Νίκος": "Πέτρος", "Ελένη": "Μαρία"})), (5, swap("wczoraj " + greek, {"Νίκος": "Łukasz", "Ελένη": "Šárka"}))]
    assert run(spark, docs, [(1, item), (2, greek)]) == [(1, 1), (3, 1), (4, 2), (5, 2)]


def test_tiny_items_need_a_text_of_their_own(spark):
    docs = spark.createDataFrame([(1, "the yes man spoke here now and then"), (2, "Yes"), (3, "here now"), (4, "so we are here now too"), (5, "which city is largest of all")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "yes"), (8, "here now"), (9, "Which city is largest")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in templates.contaminated(docs, items).collect()}
    assert got == {(2, 7), (3, 8), (5, 9)}


def test_hits_are_sent_on_some_rows_at_a_time(monkeypatch):
    """A slice full of one passage: its slots, lists of strings, are never all held at once, and no window is lost."""
    from types import SimpleNamespace

    import pyarrow as pa

    class Rows:
        def mapInArrow(self, run, schema):  # noqa: N802
            return run

    monkeypatch.setattr("pyspark.TaskContext.get", lambda: SimpleNamespace(partitionId=lambda: 0))
    schema = "item_id long, item_row long, h long, item_at long, item_windows long, item_typed long, item_slots array<string>, item_plain boolean"
    n = 5000
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(["we told Anna that all of it came to 7 km"] * n)], names=["item_id", "text"])
    out = list(templates._hits(Rows(), 1, 8, None, None, schema)(iter([batch])))
    assert max(b.num_rows for b in out) <= 4096
    rows = pa.Table.from_batches(out).to_pylist()
    one = [{k: v for k, v in r.items() if k not in ("item_id", "item_row")} for r in rows if r["item_id"] == 0]
    assert len(rows) == n * len(one) and {r["item_at"] for r in one} == {0, 1, 2, 3}
    assert sorted({r["item_row"] for r in rows}) == list(range(n)) and all(r["item_id"] == r["item_row"] for r in rows)
