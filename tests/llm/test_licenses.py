import pytest

from rankloom.llm import licenses

# The notices the tables plant, as they stand.
NOTICES = {"cc-by-nc": "Licensed under CC BY-NC 4.0.", "gpl": "This work is licensed under the GNU General Public License, version 3.",
           "apache": "Licensed under the Apache License, Version 2.0.", "mit": "Released under the MIT License.", "proprietary": "All rights reserved."}
PLAIN = ["Ordinary prose about a harbour, the weather and a committee.", "The license of the driver was taken away on Monday.",
         "He reserved all his rights to the table in the restaurant.", "Public transport is free in the general area, version or not."]


@pytest.fixture(scope="module")
def judged(spark, documents):
    rows = [(100_000 + n, x) for n, x in enumerate([*NOTICES.values(), *PLAIN, None, "", "two words",
            "prefix line\n/* Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in */\nlast",
            "All rights reserved. " + "and then a long tale of something else entirely follows here " * 40, "x " * 40000])]
    both = documents.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    return {r.doc_id: r for r in licenses.license_scan(both).collect()}


def test_notices_in_documents(documents, judged):
    for r in documents.collect():
        lines = r.text.split("\n")
        want = ",".join(f"{n}:{family}" for n, line in enumerate(lines) for family, notice in NOTICES.items() if line == notice)
        assert judged[r.doc_id].hits == want and judged[r.doc_id].n_paragraphs == len(lines)


def test_families_and_unknown(judged):
    for n, family in enumerate(NOTICES):
        assert judged[100_000 + n].families == family
    for n in range(len(NOTICES), len(NOTICES) + len(PLAIN) + 3):
        assert judged[100_000 + n].n_licenses == 0 and judged[100_000 + n].hits == ""
    assert judged[100_012].hits == "1:mit"


def test_rows(awkward, nothing):
    out = licenses.license_scan(awkward).collect()
    assert len(out) == awkward.count()
    assert {r.doc_id: r.hits for r in out}[10] == "0:apache,2:mit"
    assert licenses.license_scan(nothing).count() == 0


def test_held_out_windows_of_templates(spark, documents):
    """Spans the classifier has not seen are given to their family."""
    model, _ = licenses.train(documents)
    rows = spark.createDataFrame([(label, words) for label, words, held in licenses.spans() if held], "label int, words array<string>")
    right = model.transform(licenses._vectors(rows)).where("label = prediction").count()
    assert right >= 0.9 * rows.count()


def test_native_plan(documents):
    plan = licenses.license_scan(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_notices_within_long_lines(spark, documents):
    """Alone, or at the start, in the middle or at the end of a line: a notice is found."""
    prose = [w for r in documents.orderBy("doc_id").limit(40).collect() for line in r.text.split("\n")
             if line not in NOTICES.values() for w in line.split()]
    rows, want = [], {}
    for n, (family, notice) in enumerate((f, x) for f, x in NOTICES.items() for _ in range(4)):
        for m, others in enumerate((0, 1, 3, 10, 20, 60, 300)):
            for k, before in enumerate((0, others // 2, others)):
                at = (n * 997 + m * 311 + k * 53) % (len(prose) - 400)
                key = len(rows)
                rows.append((key, " ".join([*prose[at:at + before], notice, *prose[at + before:at + others]])))
                want[key] = f"0:{family}"
    for text in ("no notice here. " + " ".join(prose[:300]), "by the terms of the committee, in the public garden, he was granted free entry to the software fair"):
        want[len(rows)] = ""
        rows.append((len(rows), text))
    corpus = documents.selectExpr("-1 - doc_id as doc_id", "text")
    got = {r.doc_id: r.hits for r in licenses.license_scan(corpus.unionByName(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert {k: got[k] for k in want} == want


def test_several_and_edited_notices_in_a_line(spark, documents):
    tale = "and then a long tale of something else entirely follows here " * 6
    agpl = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Afero General "
            "Public License as published by the Free Software Foundation.")
    texts = {f"{tale}{NOTICES['mit']} {tale}{NOTICES['apache']}\n{tale}": ("0:apache,0:mit", 2),
             f"{NOTICES['mit']} {NOTICES['cc-by-nc']} {tale}{NOTICES['mit']}": ("0:cc-by-nc,0:mit", 1),
             f"{tale}\n{tale}This work is licensed under a Creative Commons Attribution 3.0 International License. {tale}": ("1:cc-by", 2),
             f"{tale}{agpl.replace('Afero', 'Affero').replace('modify', 'alter')} {tale}": ("0:agpl", 1)}
    df = spark.createDataFrame([(100_000 + n, t) for n, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.hits, r.n_paragraphs) for r in licenses.license_scan(documents.select("doc_id", "text").unionByName(df)).collect()}
    assert [got[100_000 + n] for n in range(len(texts))] == list(texts.values())


def test_unknown_rows_have_no_triple_of_a_template(spark):
    """Also where the notice stands late in a long line."""
    tale = "a long tale of something else entirely " * 40
    df = spark.createDataFrame([(1, tale + NOTICES["gpl"]), (2, tale)], "doc_id long, text string")
    assert [len(r.words) for r in licenses._unlike(df, 1000, "text").collect()] == [len(tale.split())]
