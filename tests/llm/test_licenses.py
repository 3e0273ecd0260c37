"""License scan against a plain scan of every phrase place and every block and template pair."""

import random
import re

from pyspark.sql import functions as F

from parcelle.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def brute(text, threshold=licenses.THRESHOLD):
    text = lower(text or "")
    words = WORD.findall(text)
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    more, score = set(), 0.0
    for block in re.split(r"\n|(?<=[.!?])(?=[\x20\x09-\x0D]|$)", text):
        own = set(WORD.findall(block))
        for label, t in licenses.TEMPLATES:
            s = set(t.split())
            if len(own & s) >= threshold * len(s) - 1e-9:
                more.add(label)
                score = max(score, len(own & s) / len(s))
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | more)), score)


def rows(df):
    cols = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return sorted(((r.doc_id, *(r[c] for c in cols)) for r in licenses.scan(df).collect()), key=str)


def test_equals_brute_force_on_made_texts(spark):
    r = random.Random(3)
    filler = "the of and a in this is under license software public general mit cc by gnu apache version 2 0 4 é ñandú ÀB".split()
    texts = [None, "", " \n ", "MIT License mit license", "cc by cc by", "CC-BY-NC 4.0", "gnu general public\nlicense", "x" * 70000]
    for _ in range(150):
        t = r.choice(licenses.TEMPLATES)[1].split()
        if r.random() < 0.5:
            t = [w for w in t if r.random() > 0.12]
        if r.random() < 0.3:
            r.shuffle(t)
        texts.append(r.choice(["", "Words. ", "words\n"]) + " ".join(r.choices(filler, k=r.randrange(12))) + r.choice([" ", ". ", "\n"]) + r.choice([" ", "-"]).join(t).title()
                     + r.choice([".", "!", " ", "\n"]) + " ".join(r.choices(filler, k=r.randrange(40))))
    data = [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(5, texts[12]), (5, texts[12])]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("labels", F.lit("own"))
    assert rows(df) == sorted(((d, *brute(t)) for d, t in data), key=str)


def test_equals_brute_force_on_documents(spark):
    from conftest import SF_SMALL
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert rows(df) == sorted(((r.doc_id, *brute(r.text)) for r in df.collect()), key=str)


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


NOTICES = {
    "gpl-notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
                  "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "lgpl-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
                   "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "bsd-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "mit-notice": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"),',
    "isc-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that",
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed",
}


def test_wrapped_and_commented_notices(spark, tmp_path):
    from textwrap import wrap

    from parcelle.llm import queries
    texts = [(label, f"code here{end}{end}" + end.join(mark + x for x in wrap(t, width)) + f"{end}{mark.rstrip()}{end}more code")
             for label, t in NOTICES.items() for width in (40, 70) for mark in ("", "# ", " * ", "// ") for end in ("\n", "\r\n")]
    # Half a notice on either side of a blank line, or of a bare comment mark, is none.
    words = NOTICES["bsd-notice"].split()
    texts += [("", " ".join(words[:10]) + gap + " ".join(words[10:])) for gap in ("\n\n", "\n * \n * ", "\r\n \r\n")]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in queries.op8_licenses(spark, str(tmp_path)).collect()}
    for i, (label, _) in enumerate(texts):
        assert label in out[i].labels.split(",") and (out[i].score >= licenses.THRESHOLD) == bool(label), (label, texts[i], out[i])
