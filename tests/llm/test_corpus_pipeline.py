"""The stages over the small tables, each against a plain check of its own input; guard of the entry file."""

import re
import subprocess
import sys

import corpus_pipeline
from conftest import ROOT, SF_SMALL
from test_simhash import brute_components

from parcelle.llm.tables import saved


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, out = docs.columns, [docs]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = saved(stage(spark, docs, SF_SMALL), f"stage{i}")
        assert docs.columns[:len(columns)] == columns and (docs.columns == columns or i == 4)
        out.append(docs)
    rows = [{r.doc_id: r for r in d.collect()} for d in out]
    assert all(set(b) <= set(a) for a, b in zip(rows, rows[1:]))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    good = [d for d in rows[0] if labels.get(d) == 1]
    assert sum(d in rows[1] for d in good) > 0.95 * len(good)
    comps = brute_components([(d, r.text) for d, r in rows[1].items()], 4)
    assert set(rows[2]) == {c for _, _, c in comps}
    items = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    leaks = {d for d, r in rows[2].items() if any(t in (r.text or "") for t in items)}
    assert not leaks & set(rows[3]) and len(rows[2]) - len(rows[3]) <= len(leaks) + 3
    pat = re.compile(r"\S+@\S+\.\w+|\b\d{16}\b|\b\d+\.\d+\.\d+\.\d+\b")
    for d, r in rows[3].items():
        found = pat.findall(r.text or "")
        assert set(rows[4]) == set(rows[3]) and not any(f in rows[4][d].text for f in found)
        assert r.text is None or rows[4][d].n_chars == len(rows[4][d].text)
    assert set(rows[5]) == set(rows[4])


def test_entry_works_without_the_operators(tmp_path):
    import shutil
    shutil.copytree(ROOT, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') or k == 'pipeline' for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", check=True, timeout=120)
