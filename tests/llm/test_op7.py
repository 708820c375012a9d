"""Licence rules on whole licence texts, notices and wrapped lines."""

from geotally.llm import op7_licences as op

S = op.SENTENCES
MIT = f"Copyright (c) 2020 Somebody.\n\n{S['mit-grant-only']}\n\n{S['mit-notice']}\n\n{S['as-is']} {S['mit-liability']}\n"
BSD3 = f"{S['bsd-source']}\n{S['bsd-binary']}\n{S['bsd-names']}\n"
CASES = [
    (1, MIT, ["MIT"]),
    (2, MIT.replace(" to ", "\nto  ").replace("Software", "SOFTWARE"), ["MIT"]),
    (3, BSD3, ["BSD-3-Clause"]),
    (4, BSD3.replace(S["bsd-names"], "Other words."), ["BSD-2-Clause"]),
    (5, "Some text without end\nLicensed under the Apache License, Version 2.0.\nMore text.", ["Apache-2.0"]),
    (6, "A. Licensed under CC BY-NC 4.0. B.\nAll rights reserved.", ["CC-BY-NC-4.0", "LicenseRef-all-rights-reserved"]),
    (7, "Released under the MIT License.\n" * 2, ["MIT", "MIT"]),
    (8, "This text is about the Apache License and the MIT License.", []),
    (9, "eLicensed under CC BY-NC 4.0. éLicensed under CC BY-NC 4.0.", []),
    (10, None, []), (11, "", []), (12, ". . !\n\n?", []),
    (13, f"{S['bsd-binary']} {S['bsd-source']}", []),
    (14, "# Copyright 2020 Foo LLC\n#\n# Licensed under the Apache License, Version 2.0 (the \"License\");\n# you may not use this file except in compliance with the License.\n# You may obtain a copy of the License at\n#\n#     http://www.apache.org/licenses/LICENSE-2.0\n#\nimport os", ["Apache-2.0"]),
    (15, "/*\n" + "".join(f" * {x}\n *\n" for x in ("Copyright (c) Foo", S["mit-grant-only"].replace(" to ", "\n * to "), S["mit-notice"], S["as-is"] + " " + S["mit-liability"])) + " */", ["MIT"]),
    (16, "Zażółć gęślą.\n" * 3 + "é\n" + "All rights reserved.\n" + "word " * 50_000 + "\n\n" + S["isc-grant"], ["ISC", "LicenseRef-all-rights-reserved"]),
]


def test_cases(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in CASES], "doc_id long, text string, found string").repartition(2)
    got = {r.doc_id: r.licences for r in op.scan(docs).collect()}
    assert got == {i: x for i, _, x in CASES}
    plan = op.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert op.scan(docs.limit(0)).count() == 0
    assert [r.licences for r in op.scan(docs.where("doc_id = 1").union(docs.where("doc_id = 1"))).collect()] == [["MIT"]] * 2


def test_cases_equal_the_twin(spark, tmp_path):
    import duckdb

    spark.createDataFrame([(i, t) for i, t, _ in CASES], "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    df = op.op7_licences(spark, str(tmp_path))
    twin = con.execute(op.SQL)
    at = [[d[0] for d in twin.description].index(c) for c in df.columns]
    assert sorted(map(tuple, df.collect())) == sorted(tuple(r[i] for i in at) for r in twin.fetchall())
