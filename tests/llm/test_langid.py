import zlib

import numpy as np

from weftline.llm import langid, queries

from .fixtures import SCHEMA, clashing, docs, odd_rows, prose

SF = "/root/testdata/sf0.1"


def test_gradients_are_those_of_the_loss():
    """Backpropagation through time against differences of the loss, with segments of several sizes."""
    rng = np.random.default_rng(0)
    model = {k: v.astype(np.float64) for k, v in langid.new_model(3, hidden=4).items()}
    x, y, sizes = rng.integers(97, 101, (5, 6)), np.array([0, 1, 2, 1, 0]), np.array([6, 3, 6, 1, 5])
    weight = np.array([1.0, 0.5, 2.0, 0.5, 1.0])
    _, grad = langid.gradients(model, x, sizes, y, weight)
    for name in model:
        flat = model[name].reshape(-1)
        for i in rng.choice(np.flatnonzero(np.abs(grad[name].reshape(-1)) > 1e-6), 6):
            old, step, loss = flat[i], 1e-3, []
            for s in (step, -step):
                flat[i] = old + s
                loss.append(langid.gradients(model, x, sizes, y, weight)[0])
            flat[i] = old
            assert abs((loss[0] - loss[1]) / (2 * step) - grad[name].reshape(-1)[i]) < 2e-4, (name, i)


def test_segments_are_the_whole_text():
    """Every byte once, blanks and case included, no character cut."""
    for text in ["", "a", " A  b\n", "x" * 95, "x" * 96, "x" * 97, "ü" * 200, "漢字" * 150, "a😀" * 99, prose(3, 200)]:
        data = text.encode()
        x, sizes = langid.segments_of(data)
        parts = [bytes(r[:n]) for r, n in zip(x, sizes)]
        assert b"".join(parts) == data and all(0 < n <= langid.SEGMENT for n in sizes) and [p.decode() for p in parts] is not None


def test_letters_are_those_of_the_category():
    assert not any(map(langid.has_letter, [None, "", " \n", "123", "½", "²", "Ⅷ", "①", "_", "!?", "😀"]))
    assert all(map(langid.has_letter, ["a", "1ß", "漢", "ª", "я"]))


def test_held_out_accuracy(spark):
    docs_ = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text").collect()}
    found = {r["doc_id"]: r for r in queries.op8_language(spark, SF).collect()}
    assert found.keys() == docs_.keys()
    known = {r["lang"] for r in docs_.values()}
    for i, r in found.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1
        assert r["lang_pred"] in known or (r["lang_pred"] == "und" and not langid.has_letter(docs_[i]["text"]))
    held = [i for i in found if found[i]["held_out"] and docs_[i]["lang"] and found[i]["lang_pred"] != "und"]
    right = np.mean([found[i]["lang_pred"] == docs_[i]["lang"] for i in held])
    scores = sorted(found[i]["score"] for i in held)
    wrong = [(i, found[i]["lang_pred"], docs_[i]["lang"], (docs_[i]["text"] or "")[:60]) for i in held if found[i]["lang_pred"] != docs_[i]["lang"]]
    print("accuracy", right, "least scores", scores[:5], scores[len(scores) // 100], wrong[:8])
    assert right > 0.95


def test_pooling_is_the_network_run_segment_by_segment(spark, monkeypatch):
    """The query's path against a plain recurrence, one segment and one byte at a time."""
    model = langid.new_model(3)

    def plain(data):
        total = np.zeros(3)
        x, sizes = langid.segments_of(data)
        for row, n in zip(x, sizes):
            states = {}
            for d in langid.DIRECTIONS:
                h, k = np.zeros(langid.HIDDEN), langid.HIDDEN
                for t in range(n) if d == "f" else range(n - 1, -1, -1):
                    a, g = model["w" + d][row[t]], h @ model["u" + d]
                    z, r = 1 / (1 + np.exp(-(a[:k] + g[:k]))), 1 / (1 + np.exp(-(a[k:2 * k] + g[k:2 * k])))
                    h = z * h + (1 - z) * np.tanh(a[2 * k:] + r * (g[2 * k:] + model["c" + d]))
                    states[d, t] = h
            for t in range(n):
                e = np.exp(np.concatenate([states[d, t] for d in langid.DIRECTIONS]) @ model["v"] + model["o"])
                total += e / e.sum()
        return total / total.sum()

    texts = [prose(i, 60) for i in range(4)] + ["", None, "12 34", "Wörter " * 40, "x"]
    for gathered in (1, 1 << 20):
        monkeypatch.setattr(langid, "GATHERED", gathered)
        monkeypatch.setattr(langid, "TOGETHER", 7)
        for text, got in zip(texts, langid.document_probs(texts, model, 3), strict=True):
            assert (got is None) == (not langid.has_letter(text))
            assert got is None or np.allclose(got, plain(text.encode()), atol=1e-5)


def test_odd_rows(spark):
    df = clashing(docs(spark, odd_rows()))
    out = langid.identify(df, df)
    assert set(out.columns) == set(df.columns) and out.columns[-2:] == ["lang_pred", "score"]
    found = out.collect()
    assert len(found) == len(odd_rows())
    for r in found:
        und = not langid.has_letter(r["text"])
        assert (r["lang_pred"] == "und" and r["score"] == 0) if und else r["lang_pred"] in ("en", "de", "fr")
    assert {r["lang_pred"] for r in langid.identify(df, df.limit(0)).collect()} == {"und"}
    assert langid.identify(spark.createDataFrame([], SCHEMA), df).collect() == []


def test_rare_languages_are_in_the_sample(spark):
    rows = [(k, prose(k, 6), "en" if k % 2 else "de", "a", 1) for k in range(400)] + [(1000 + k, prose(k, 6), lang, "a", 1) for k, lang in enumerate(["fi", "fi", "eo"])]
    given = docs(spark, rows)
    found = langid.training_texts(given, "doc_id", "text", "lang", n_docs=40)
    langs = [lang for lang, _ in found]
    assert len(found) == 40 and langs.count("fi") == 2 and langs.count("eo") == 1 and min(langs.count("en"), langs.count("de")) >= 10
    assert len(langid.training_texts(given, "doc_id", "text", "lang", n_docs=1000)) == len(rows)
