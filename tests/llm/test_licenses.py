import random
from math import ceil

import duckdb

from weftline.llm import licenses, oracles, queries

from .fixtures import SCHEMA, clashing, docs, odd_rows, prose


def brute(text):
    words = licenses.words_of((text or "").encode())
    places, base = [], set()
    for phrase, label in licenses.PHRASES.items():
        want = phrase.encode().split()
        for i in range(len(words)):
            if words[i:i + len(want)] == want:
                places.append(i)
                base.add(label)
    labels, best = set(base), 1.0 if places else 0.0
    for t, label in licenses.TEMPLATES.items():
        want, length = set(t.encode().split()), ceil(licenses.BLOCK * len(t.split()))
        for i in range(max(1, len(words) - length + 1)):
            share = len(want.intersection(words[i:i + length])) / len(want)
            if share >= licenses.CONTAINMENT - 1e-9:
                labels.add(label)
                best = max(best, share)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), best


def texts():
    rng = random.Random(2)
    out = ["Under the MIT License. under-the mit license", "cc by nc by nc cc by nc", "APACHE license version 2.0", "apache license\nversion 2", "under the mit licenses"]
    for k in range(200):
        words = rng.choice([*licenses.TEMPLATES]).split()
        rng.shuffle(words)
        cut = rng.randrange(3)
        line = words[cut:] + prose(k, rng.randrange(6)).split() + rng.choice([[], words[:2]])
        out.append(prose(k, 4) + "\n" + " ".join(line).title() + "\n" + prose(k + 1, 3))
    return out


def test_against_brute_force(spark):
    given = texts()
    found = licenses.scan_licenses(docs(spark, [(i, t, "en", "a", 1) for i, t in enumerate(given)])).collect()
    assert len(found) == len(given)
    for r in found:
        assert tuple(r)[1:] == brute(given[r["doc_id"]])
    assert sum(bool(r["labels"]) for r in found) > 60


def test_notices_over_lines_with_words_missing(spark):
    """Blocks go over line breaks; long notices may lack a few words, and then score under 1; short ones may not."""
    notices = [
        ("/* Redistribution and use in source and\n * binary forms, with or without\n\n modification, are permitted provided that\n the following conditions are met: */", "bsd", 1.0),
        ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy was not distributed with this\nfile, You can get one at http://mozilla.org/MPL/2.0/.", "mpl-2", None),
        ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\nat your choice any later version.", "gpl-3", None),
        ("licensed under cc by 4.0", "", 0.0), ("permission is hereby granted", "", 0.0),
    ]
    found = {r["doc_id"]: r for r in licenses.scan_licenses(docs(spark, [(i, prose(i, 50) + "\n" + t + "\n" + prose(i + 9, 50), "en", "a", 1) for i, (t, _, _) in enumerate(notices)])).collect()}
    for i, (_, label, score) in enumerate(notices):
        assert found[i]["labels"] == label and (found[i]["score"] == score if score is not None else 0.95 <= found[i]["score"] < 1), i
    join = licenses.ContainmentJoin(licenses.TEMPLATES, {}, licenses.CONTAINMENT)
    assert max(len(order) - need + 1 for order, need, _, _ in join.sets) >= 2  # prefixes of more than one word


def test_sql_agrees(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.sql(oracles.oracle_sql()["op6_licenses"])
    names = want.columns
    rows = {tuple(x) for x in want.fetchall()}
    assert rows == {tuple(r[n] for n in names) for r in queries.op6_licenses(spark, sf).collect()}


def test_odd_rows(spark):
    found = licenses.scan_licenses(clashing(docs(spark, odd_rows()))).collect()
    assert sorted((tuple(r) for r in found), key=repr) == sorted(((r[0], *brute(r[1])) for r in odd_rows()), key=repr)
    assert licenses.scan_licenses(spark.createDataFrame([], SCHEMA)).collect() == []
