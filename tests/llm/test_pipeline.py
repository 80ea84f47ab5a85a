"""The corpus pipeline against the stages done by brute force."""

import math
import os
import random
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from panelspark.llm import language_id

SF = "/root/testdata/sf0.001"


def test_stage_names():
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "jaccard_join", "suffix_dedup", "packing"]


def test_decisions_take_effect(spark):
    rng = random.Random(1)
    en, fr = "the of and that with this from have which".split(), "le la de les des une dans pour que".split()
    say = lambda words, n: " ".join(rng.choice(words) + rng.choice(words) for _ in range(n))
    docs = [(i, say(en if i % 2 else fr, 80), "en" if i % 2 else "fr", "s", 0) for i in range(40)]
    shared = say(en, 30)
    docs += [(50, docs[1][1], "en", "s", 0), (51, docs[1][1].replace(" ", "  "), "en", "s", 0), (52, "12345 !!", "en", "s", 0), (53, None, "en", "s", 0), (54, say(en, 60) + " " + shared, "en", "s", 0), (55, say(en, 60) + " " + shared, "en", "s", 0)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    kept = frame
    counts = []
    for _, stage in pipeline.STAGES[:-1]:
        kept = pipeline.stored(stage(spark, kept, ""), "t")
        assert kept.columns == frame.columns
        counts.append({r.doc_id for r in kept.select("doc_id").collect()})
    assert counts[0] == set(range(40)) | {50, 51, 54, 55}
    assert counts[1] == set(range(40)) | {54, 55}
    assert counts[2] == counts[1]
    rows = {r.doc_id: r for r in kept.collect()}
    assert shared in rows[54].text and shared not in rows[55].text and rows[55].n_chars == len(rows[55].text)
    assert rows[1].text == docs[1][1] and rows[1].n_chars == 0
    packed = pipeline.STAGES[-1][1](spark, kept, "").collect()
    assert {r.doc_id for r in packed} == counts[2]


def likeliest(model, text):
    """Share of the likeliest language by forward-backward in plain Python, word by word."""
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    if not words:
        return 0.0
    k = range(len(model.labels))
    seen = [[math.exp(x) for x in row] for row in model.emissions(words).tolist()]
    move = [[math.exp(x) for x in row] for row in model.transitions.tolist()]
    ahead, back = [seen[0]], [[1.0] * len(model.labels)]
    for row in seen[1:]:
        now = [sum(ahead[-1][i] * move[i][j] for i in k) * row[j] for j in k]
        ahead.append([x / sum(now) for x in now])
    for row in reversed(seen[1:]):
        now = [sum(move[i][j] * row[j] * back[-1][j] for j in k) for i in k]
        back.append([x / sum(now) for x in now])
    total = [0.0] * len(model.labels)
    for a, b in zip(ahead, reversed(back), strict=True):
        both = [x * y for x, y in zip(a, b, strict=True)]
        total = [t + x / sum(both) for t, x in zip(total, both, strict=True)]
    return max(total) / len(words)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def uncut(rows, least=100):
    """Texts without the bytes of strings that start earlier; rows of which nothing is left go."""
    seen, out = set(), []
    for i, text, lang in sorted(rows):
        raw = text.encode()
        gone = [False] * len(raw)
        for s in range(len(raw) - least + 1):
            if raw[s : s + least] in seen:
                gone[s : s + least] = [True] * least
            seen.add(raw[s : s + least])
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g).decode(errors="ignore") if any(gone) else text
        if kept or not any(gone):
            out.append((i, kept, lang))
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    voices = {"en": "the of and that with this from have which".split(), "fr": "le la de les des une dans pour que".split(), "tr": "bir ve bu için ile çok daha İş".split()}
    say = lambda lang, n: " ".join(rng.choice(voices[lang]) + rng.choice(voices[lang]) for _ in range(n))
    rows = [(i, say(lang, rng.randrange(30, 120)), lang) for i, lang in enumerate(["en", "fr", "tr"] * 15)]
    shared = say("fr", 40)
    rows += [(100 + i, say("fr", 50 + i) + " " + shared + ", " + say("fr", 20), "fr") for i in range(4)]
    for i in range(6):  # copies and near copies of one text
        words = rows[3][1].split()
        for _ in range(i):
            words[rng.randrange(len(words))] = f"edit{i}"
        rows.append((200 + i, " ".join(words), None))
    rows += [(300, "12345 !!", "en"), (301, None, "en"), (302, "", None), (303, shared, "fr"), (304, " ".join(rng.choice(voices["en"] + voices["fr"]) for _ in range(400)), "en"), (305, say("en", 3000), "en")]
    rng.shuffle(rows)
    return rows


def frame_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0, "x", "y") for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long, spans string, rep string")


def test_run_by_force(spark, corpus, tmp_path):
    frame_of(spark, corpus).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    read = spark.read.parquet(str(tmp_path / "documents.parquet"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = language_id.fit_crf(language_id.training_sample(read, held, "text", "lang", language_id.TRAIN_DOCS, language_id.TRAIN_CHARS))
    scores = {i: likeliest(model, t) for i, t, _ in corpus}
    assert all(abs(x - 0.5) > 1e-6 for x in scores.values())
    left = [r for r in corpus if scores[r[0]] >= 0.5]
    sets = {i: shingles(t) for i, t, _ in left}
    root = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            root[i] = min(root[j] for j in sets if j == i or sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]))
    left = uncut([r for r in left if root[r[0]] == r[0]])
    assert len(corpus) - 12 < len(left) + 10 and 303 not in {i for i, _, _ in left}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t, _ in left}
    got, sequences = {}, {}
    for r in pipeline.run(spark, str(tmp_path)).collect():
        got.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got.keys() == want.keys()
    for i, pieces in got.items():
        pieces.sort(key=lambda r: r.start)
        assert [x for r in pieces for x in r.ids] == want[i] and [r.start for r in pieces] == [sum(p.length for p in pieces[:k]) for k in range(len(pieces))]
    for places in sequences.values():
        size = sum(n for _, n in places)
        assert size <= 2048 and size & size - 1 == 0 and [a for a, _ in sorted(places)] == [sum(n for _, n in sorted(places)[:k]) for k in range(len(places))]


def test_rows_that_share_an_id_are_judged_by_themselves(spark, corpus):
    en = [t for i, t, lang in sorted(corpus, key=lambda r: r[0]) if lang == "en" and i < 45]
    passage, other = en[0] + " " + en[1], " ".join(en[2:6])
    rows = [(1, passage, "en"), (2, passage, "en"), (2, other, "en"), (2, None, "en"), (None, en[7], "en"), (None, "777", "en"), (3, en[7], "en")]
    kept = frame_of(spark, rows)
    for _, stage in pipeline.STAGES[:-1]:
        kept = pipeline.stored(stage(spark, kept, ""), "t")
        assert kept.columns == frame_of(spark, []).columns
    assert sorted(r.text for r in kept.collect()) == sorted([passage, other, en[7]])
    none = frame_of(spark, [])
    for _, stage in pipeline.STAGES:
        none = pipeline.stored(stage(spark, none, ""), "t")
        assert none.count() == 0


def test_columns_of_the_stages_own_names_stay(spark, corpus):
    en = [t for i, t, lang in sorted(corpus, key=lambda r: r[0]) if lang == "en" and i < 45]
    rows = [(1, en[0] + " " + en[1], "en"), (2, "start " + en[0] + " " + en[2], "en"), (2, en[3], "en"), (None, en[4], "en")]
    named = frame_of(spark, rows).withColumns({"Pipeline_row_number": F.lit(7), "pipeline_spans": F.lit("x"), "pipeline_row_number_": F.col("text")})
    kept = named
    for _, stage in pipeline.STAGES[:-1]:
        kept = pipeline.stored(stage(spark, kept, ""), "t")
        assert kept.columns == named.columns
    got = kept.collect()
    assert len(got) == 4 and all((r.Pipeline_row_number, r.pipeline_spans) == (7, "x") for r in got)
    assert sum(r.text != r.pipeline_row_number_ for r in got) == 1  # one text was cut


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
def test_run(spark):
    got = pipeline.run(spark, SF)
    assert got.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(got.columns)
