"""Encoding, packing and reading levels."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from frameloom.llm import encoding as E
from frameloom.llm import packing as P
from frameloom.llm import reading as R

pytest.importorskip("tokenizers")
PATH = f"{E.FOLDER}/byte_bpe_50k.json"
TEXTS = [None, "", " ", "\n\n\t", "plain words here", "naïve façade", "日本語の文章", "👩‍🔧🏴‍☠️ﬁ\u0000﻿", "<|endoftext|> stays text", "a" * 20000, "x = 1;\r\n" * 50, "́combining", "ééé" * 100]


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "ids", 5) for i, t in enumerate(texts)], "doc_id long, text string, ids string, n_tokens int")


def test_ids_equal_the_library_and_decode_to_the_text(spark):
    df = documents(spark, TEXTS)
    got = {r.doc_id: r.ids for r in E.encode_documents(df).collect()}
    t = E.tokenizer(PATH)
    for i, x in enumerate(TEXTS):
        assert got[i] == (t.encode(x, add_special_tokens=False).ids if x else [])
    assert 50256 not in got[8]
    back = {r.doc_id: r.text for r in E.decode_documents(E.encode_documents(df)).collect()}
    assert all(back[i] == (x or "") for i, x in enumerate(TEXTS))
    assert E.encode_documents(df.limit(0)).count() == 0
    assert E.encode_documents(df.select(F.lit(None).cast("long").alias("doc_id"), F.lit("a").alias("text"))).first().ids == t.encode("a").ids


def test_the_second_library_agrees():
    e = P.ranks(f"{E.FOLDER}/byte_bpe_50k.tiktoken")
    assert E.batch_ids(PATH, TEXTS) == [e.encode_ordinary(x) if x else [] for x in TEXTS]


def test_offsets_cover_split_characters(spark):
    table = E.token_bytes(PATH)
    assert len(E.byte_table()) == 256 and len(set(E.byte_table().values())) == 256
    for r in E.encode_with_offsets(documents(spark, TEXTS)).collect():
        text = TEXTS[r.doc_id] or ""
        at = 0
        for i, s, e in zip(r.ids, r.starts, r.ends):
            n = len(table[i])
            assert text[s:e].encode().find(table[i]) >= 0
            at += n
        assert at == len(text.encode()) and (not r.ids or (r.starts[0] == 0 and r.ends[-1] == len(text)))


def test_streams_of_cut_ids():
    table = E.token_bytes(PATH)
    ids = E.batch_ids(PATH, ["日本👩‍🔧 語"])[0]
    assert "".join(E.decode_stream([[i] for i in ids], table)) == "日本👩‍🔧 語"
    assert "�" in E.decode(ids[:-1] if len(table[ids[-1]]) < 3 else ids[:1], table) or len(ids) < 2
    assert list(E.decode_stream([[]], table)) == [""]


def test_hilbert_curve_visits_neighbours():
    points = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    keys = P.hilbert(points, 3)
    assert sorted(keys) == list(range(512))
    path = points[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_packer_fills_containers():
    rng = random.Random(3)
    p, sizes = P.Packer(100), [rng.randint(0, 60) for _ in range(3000)]
    where = [c for lo in range(0, 3000, 500) for c in p.add(sizes[lo : lo + 500])]
    load = np.bincount(where, sizes)
    assert load.max() <= 100 and load.sum() / (100 * len(load)) > 0.98


def test_pack_holds_every_document_once(spark):
    words = ["alpha", "beta", "gamma", "delta"]
    rng = random.Random(0)
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 120))) for _ in range(600)] + [None, "", " word" * 5000] + ["same text again"] * 300
    df = documents(spark, texts)
    targets = spark.createDataFrame([(1, 64, "x"), (2, 1000, "y"), (3, None, ""), (4, 0, ""), (1, 64, "z")], "target_id int, capacity_tokens int, curve string")
    rows = P.pack(df, targets).collect()
    size = {i: len(x) for i, x in enumerate(E.batch_ids(PATH, texts))}
    for target, capacity in ((1, 64), (2, 1000)):
        own = [r for r in rows if r.target_id == target]
        load, parts = {}, {}
        for r in own:
            load[r.container_id] = load.get(r.container_id, 0) + r.n_tokens
            parts.setdefault(r.doc_id, []).append((r.piece, r.first_token, r.n_tokens))
        assert max(load.values()) <= capacity and sum(load.values()) / (capacity * len(load)) > 0.93
        assert set(parts) == set(size)
        for i, p in parts.items():
            p.sort()
            assert sum(n for *_, n in p) == size[i] and [f for _, f, _ in p] == [sum(n for *_, n in p[:k]) for k in range(len(p))]
            assert len(p) == 1 if size[i] <= capacity else all(n == capacity for *_, n in p[:-1])
    assert {r.target_id for r in rows} == {1, 2}
    assert P.pack(df.limit(0), targets).count() == 0 and P.pack(df, targets.limit(0)).count() == 0


def test_prose_leaves_out_code_links_markup_and_other_languages():
    text = "<p>The cat can see your mat &amp; the dog.</p>\n\n```py\nthe code of the day is not for you\n```\n\n    return the of and to\n\n> It is on [the wall](http://x.y/the) and `inline the` ends. See https://a.b/c?d\n\nEl perro de la casa no es para los niños que van.\n\nそれは です。"
    said = ["the cat of the house can see your mat and the dog is on the wall", "it is for you and the wall ends", "el perro de la casa no es para los niños que van", "la casa de los que no es para el niño"]
    english = R.English([dict(R.Counter(x.split())) for x in said * 3], [True, True, False, False] * 2 + [True, True, True, False])  # one is wrong
    words = [w for s in R.prose(text, english) for w in s]
    assert words == "the cat can see your mat the dog it is on the wall and ends see".split()
    assert R.prose("", english) == [] and R.prose("```\nunclosed the of and", english) == [] and R.prose("12 34 !!", english) == []


EASY, HARD = "cat dog bag cup pot".split(), "epistemology commensurability parameterisation thermodynamics orthogonality".split()


def level_text(rng, band):
    long = (band - 1) / 4
    out = []
    for _ in range(8):
        clauses = [f"the {rng.choice(HARD if rng.random() < long else EASY)} may see this {rng.choice(HARD if rng.random() < long else EASY)}" for _ in range(1 + (rng.random() < long) + (rng.random() < long))]
        out.append(" notwithstanding that ".join(clauses).capitalize() + ".")
    return " ".join(out)


def test_bands_follow_the_labels(spark):
    rng = random.Random(8)
    bands = [rng.randint(1, 5) for _ in range(260)]
    texts = [level_text(rng, b) for b in bands]
    extra = [None, "", "the cat", "```\n" + "the of code " * 50 + "\n```", "la casa de los que no es para el niño " * 20, texts[0] + "\n" + "    code();\n" * 30]
    extra += ["la casa de los que no es para el niño que van por la calle " * 2] * 12
    df = documents(spark, texts + extra).withColumn("lang", F.expr("case when text like 'la casa%' then if(doc_id % 5 = 0, 'en', 'es') when doc_id % 11 = 0 then 'fr' when doc_id % 7 = 0 then null else 'en-GB' end"))
    labels = spark.createDataFrame([(i, b, "r1") for i, b in enumerate(bands[:160])] + [(0, None, "r2"), (1, 9, "r3"), (None, 3, "r4"), (10**9, 1, "r5")], "doc_id long, band int, rater string")
    got = {r.doc_id: r.band for r in R.reading_bands(df, labels).collect()}
    assert set(got) == set(range(260)) | {265}
    held = range(160, 260)
    assert np.mean([abs(got[i] - bands[i]) <= 1 for i in held]) > 0.95 and np.mean([got[i] == bands[i] for i in held]) > 0.5
    assert got[265] == got[0]
    assert R.reading_bands(df.limit(0), labels).count() == 0
    with pytest.raises(ValueError):
        R.reading_bands(df, labels.limit(3))


def test_calibration_sees_what_held_out_documents_look_like():
    """The error of the sentence-implied level is alike on the documents that were fitted and on others."""
    rng = random.Random(4)
    bands = np.array([rng.randint(1, 5) for _ in range(400)])
    docs = [[R.TOKEN.findall(p.lower()) for p in R.SENTENCE.split(level_text(rng, b)) if p.strip()] for b in bands]
    model = R.ReadingModel(docs[:200], bands[:200])
    fitted, held = (np.abs(model.bands(docs[lo : lo + 200]) - bands[lo : lo + 200]).mean() for lo in (0, 200))
    assert held <= fitted + 0.1
    one = model.features(docs[0], R._Scores(model.weights))
    assert len(one) == model.width() and abs(sum(one[12:17]) - 1) < 1e-9
