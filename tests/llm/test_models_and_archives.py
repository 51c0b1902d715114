"""Language, toxicity, quality, embeddings and archives."""

import base64
import hashlib
import io
import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import embeddings, language, quality, queries, sampling, tokens, toxicity, warc

from .edge import documents, rows_of, texts, words

MEDIUM = "/root/testdata/sf0.01"


def held_out(result, answers, column, predicted):
    rows = result.where("held_out").join(answers, "doc_id").select(column, predicted).collect()
    return sum(r[0] == r[1] for r in rows) / len(rows)


# --- language ---

def greedy_phrases(text, corpus):
    n, at = 0, 0
    while at < len(text):
        size = 1
        while at + size <= len(text) and text[at:at + size] in corpus:
            size += 1
        at += max(1, size - 1)
        n += 1
    return n


def test_automata_count_the_phrases_of_greedy_parsing():
    r = random.Random(4)
    corpus = ["".join(r.choice("ab ") for _ in range(80)), "".join(r.choice("abcd") for _ in range(120))]
    model = language.Automata((("x", corpus[0]), ("y", corpus[1])))
    parsed = ["".join(r.choice("abcde ") for _ in range(r.randint(1, 60))) for _ in range(50)]
    pieces = np.full((len(parsed), 64), language._END, np.uint8)
    for k, t in enumerate(parsed):
        pieces[k, :len(t)] = model.symbol[[ord(c) for c in t]]
    got = model.phrases(pieces)
    assert got.tolist() == [[greedy_phrases(t, c) for c in corpus] for t in parsed]


def test_language_of_held_out_documents(spark):
    answers = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang")
    assert held_out(queries.op2_language(spark, MEDIUM), answers, "lang", "lang_pred") > 0.97


def test_language_of_odd_rows(spark):
    out = language.identify(documents(spark)).collect()
    assert len(out) == len(texts())
    und = {r.doc_id for r in out if r.lang_pred == "und"}
    assert und >= {5, 6, 7} and 1 not in und
    assert all(0 <= r.score <= 1 for r in out) and all(r.held_out for r in out if r.doc_id is None)
    nothing = documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(nothing).collect()} == {"und"}
    assert language.identify(documents(spark, [])).collect() == []


def test_languages_of_one_large_alphabet_are_told_apart():
    """Two scripts of 300 letters each beside 61 letters that are more frequent; word lengths say nothing."""
    r = random.Random(8)
    draw = lambda first, size, n: " ".join("".join(chr(first + r.randrange(size)) for _ in range(2)) for _ in range(n))
    latin = "".join(chr(c) for c in range(0x400, 0x500) if chr(c).islower())[:61]
    common = " ".join(r.choice(latin) + r.choice(latin) for _ in range(6000))
    model = language.Automata((("a", draw(0xAC00, 300, 900)), ("b", draw(0xB400, 300, 900)), ("c", common)))
    parsed = [draw(0xB400, 300, 40), draw(0xAC00, 300, 40), draw(0x4E00, 300, 40)]
    n = np.stack([p for _, p, _ in language._measured(parsed, model)])
    assert n[0].argmin() == 1 and n[1].argmin() == 0 and len(set(n[2].tolist())) == 1


def test_rare_letters_are_parsed_as_greedily_as_frequent_ones():
    r = random.Random(12)
    letters = [chr(0x4E00 + k) for k in range(150)]
    corpus = [" ".join("".join(r.choice(letters[:n]) for _ in range(3)) for _ in range(200)) for n in (90, 150)]
    texts_ = ["".join(r.choice(letters + [" "]) for _ in range(50)).strip() for _ in range(20)] + [corpus[0][40:90].strip(), corpus[1][13:70].strip()]
    model = language.Automata((("x", corpus[0]), ("y", corpus[1])))
    got = {k: p.tolist() for k, p, _ in language._measured(texts_, model)}
    assert [got[k] for k in range(len(texts_))] == [[greedy_phrases(re.sub(" +", " ", t), c) for c in corpus] for t in texts_]


# --- toxicity ---

def test_marginals_match_enumeration():
    r = np.random.default_rng(2)
    lengths = np.array([3, 5, 1, 4])
    node, change = r.normal(0, 2, lengths.sum()), r.normal(0, 1, (2, 2))
    ahead, behind = toxicity.Chains(lengths).messages(np.exp(node), change)
    got, at = ahead * behind / (1 + ahead * behind), 0
    for n in lengths:
        total, on = 0.0, np.zeros(n)
        for tags in itertools.product((0, 1), repeat=int(n)):
            p = math.exp(sum(node[at + k] * t for k, t in enumerate(tags)) + sum(change[a, b] for a, b in zip(tags, tags[1:])))
            total += p
            on += p * np.array(tags)
        assert np.allclose(got[at:at + n], on / total)
        at += n


def test_toxicity_of_held_out_documents_and_its_spans(spark):
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.assess(docs, labels).cache()
    assert held_out(out, labels.select("doc_id", "toxic"), "toxic", "predicted") > 0.9
    row = out.join(docs, "doc_id").where("predicted = 1 AND spans LIKE '%,%' AND lang = 'en'").first()
    found = {row.text[int(s):int(e)].lower() for s, e in (x.split(":") for x in row.spans.split(","))}
    assert found & {"idiot", "moron", "stupid", "scum", "trash", "loser", "clown", "pathetic", "worthless", "disgusting"}
    out.unpersist()


def test_toxicity_of_odd_rows(spark):
    docs, none = documents(spark), spark.createDataFrame([], "doc_id long, toxic int, quality int")
    out = toxicity.assess(docs, none).collect()
    assert len(out) == len(texts()) and {r.score for r in out} == {0.0}
    foul = [(k, " ".join(words(k, 30) + (["nastyword"] if k % 2 else []) + words(k + 900, 30))) for k in range(200, 300)]
    labels = spark.createDataFrame([(k, k % 2, 1) for k, _ in foul] + [(None, 1, 1), (200, 1, 1), (201, None, 1)],
                                   "doc_id long, toxic int, quality int")
    model = toxicity.learn(documents(spark, foul), labels)
    got = toxicity.score(documents(spark, texts() + foul + [(999, "a nastyword. " * 3), (998, "Ünö nastyword")]), model)
    by_id = {r.doc_id: r for r in got.collect()}
    assert all(by_id[k].predicted == k % 2 for k, _ in foul)
    assert by_id[998].spans == "4:13" and by_id[5].predicted == by_id[6].predicted == 0
    kept = toxicity.drop_toxic(documents(spark, foul), model)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(200, 300, 2)) and kept.columns == docs.columns
    assert toxicity.score(documents(spark, []), model).collect() == []


def test_classes_of_long_texts_only_are_learned(spark):
    long = lambda k, x: " ".join(words(k, 1200) + x + words(k + 500, 1200))
    rows = [(k, long(k, ["nastyword"] if k % 2 else [])) for k in range(40)]
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(40)], "doc_id long, quality int, toxic int")
    sample = sampling.labelled_texts(documents(spark, rows), labels, "toxic", 1500, 10_000_000)
    assert sorted(sample) == sorted((t, k % 2) for k, t in rows) and min(len(t) for _, t in rows) > 6000
    one_each = sampling.labelled_texts(documents(spark, rows), labels, "toxic", 1500, 10)  # no text fits: the shortest of each
    assert sorted(one_each) == sorted((min((t for k, t in rows if k % 2 == y), key=len), y) for y in (0, 1))
    cut = sampling.labelled_texts(documents(spark, rows), labels, "toxic", 1500, 10_000_000, 6000)
    assert all(len(t) == 6000 + sampling.STRETCHES - 1 for t, _ in cut) and len(cut) == 40
    for t, y in cut:
        stretches = t.split("\n")
        whole = next(w for k, w in rows if stretches[0] in w)
        places = [whole.index(x) for x in stretches]
        assert places == sorted(places) and places[0] < len(whole) / 6 and places[-1] > len(whole) / 2
    absent = spark.createDataFrame([(k, 1, 1) for k in range(1000, 3000)], "doc_id long, quality int, toxic int")
    few = sampling.labelled_texts(documents(spark, rows), labels.union(absent), "toxic", 2, 100_000)
    assert {y for _, y in few} == {0, 1}
    books = documents(spark, rows).withColumn("lang", F.lit("book"))
    assert [lang for lang, _ in language.fit(books)] == ["book"]


def test_every_class_is_drawn(spark):
    rows = spark.range(3000).select("id", (F.col("id") % 300).alias("c"))
    assert sampling.per_class(rows, "c", "id", 1).select("c").distinct().count() == 300


# --- quality ---

def test_linear_time_score_is_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    x = quality.inputs(["to be or not to be!", "", None, "A\nB c 12"], [19, 0, None, 8])
    size = (1 << quality.BITS) + quality.STATS
    m = quality.Model(0.3, rng.normal(size=size), rng.normal(size=(size, quality.RANK)), np.zeros(quality.STATS), np.ones(quality.STATS))
    raw, _, z = quality._raw(m, x)
    for d in range(4):
        own = x.document == d
        v = np.concatenate([x.value[own], z[d]])
        at = np.concatenate([x.index[own], (1 << quality.BITS) + np.arange(quality.STATS)])
        pairs = sum(m.factor[at[i]] @ m.factor[at[j]] * v[i] * v[j] for i in range(len(v)) for j in range(i))
        assert raw[d] == pytest.approx(m.bias + m.linear[at] @ v + pairs, rel=1e-5, abs=1e-5)


def test_quality_of_held_out_documents(spark):
    answers = spark.read.parquet(f"{MEDIUM}/labels.parquet").select("doc_id", "quality")
    assert held_out(queries.op5_quality(spark, MEDIUM), answers, "quality", "predicted") > 0.93


def test_quality_of_odd_rows(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert {r.score for r in quality.assess(documents(spark), none).collect()} == {0.0}
    labels = spark.createDataFrame([(k, 0, int(k < 5)) for k in range(1, 19)], "doc_id long, toxic int, quality int")
    out = quality.assess(documents(spark), labels).collect()
    assert len(out) == len(texts()) and all(0 <= r.score <= 1 for r in out)
    assert quality.assess(documents(spark, []), labels).collect() == []


def test_long_texts_are_read_whole_and_in_pieces(monkeypatch):
    monkeypatch.setattr(tokens, "PIECE", 1 << 17)
    w = words(8, 60_000)
    got = [(int(d), int(p)) for _, _, x in tokens.groups([None, " ".join(w), "last one"]) for d, p in zip(x.document, x.place)]
    assert len(got) == len(w) + 2 and got == sorted(got)
    place = np.cumsum([0] + [len(x) + 1 for x in w])
    assert [p for d, p in got if d == 1] == place[:-1].tolist()


def test_samples_are_bounded(spark):
    rows = [(k, f"text {k}") for k in range(2000)]
    labels = spark.createDataFrame([(k, int(k % 20 == 0)) for k in range(2000)], "doc_id long, quality int")
    some = sampling.labelled_texts(documents(spark, rows), labels, "quality", 60, 100)
    assert all(sum(len(t) for t, v in some if v == y) <= 110 for y in (0, 1)) and len(some) > 15
    assert some == sampling.labelled_texts(documents(spark, rows).repartition(5), labels, "quality", 60, 100)
    got = sampling.labelled_texts(documents(spark, rows), labels, "quality", 60, 100_000)
    assert {y: sum(v == y for _, v in got) for y in (0, 1)}[0] <= 60 and sum(v for _, v in got) >= 40


# --- embeddings ---

def vectors(spark):
    r = np.random.default_rng(6)
    rows = [(k, r.normal(size=16).tolist()) for k in range(60)]
    for c in range(4):  # clusters at many distances from their centre
        centre = r.normal(size=16)
        rows += [(100 * (c + 1) + k, (centre + r.normal(size=16) * 0.04 * k).tolist()) for k in range(12)]
    same = r.normal(size=16).tolist()
    rows += [(1000 + k, same) for k in range(30)] + [(1100, [2 * x for x in same]), (1101, [-x for x in same])]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] + [1.0] * 15), (2004, [None] + [1.0] * 15),
             (2005, [float("inf")] + [1.0] * 15), (None, same), (2006, [1.0, 0.0]), (2007, [1.0, 0.1]), (2008, [1.0]), (0, rows[0][1])]
    return rows, spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<float>, id string, keys string")


def brute_links(rows):
    valid = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
             if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    unit = [(i, v / math.sqrt((v * v).sum())) for i, v in valid]
    near = [[len(a) == len(b) and float(a @ b) >= 0.9 for _, b in unit] for _, a in unit]
    low = [i for i, _ in unit]
    for _ in unit:
        low = [min([low[k]] + [low[j] for j, on in enumerate(near[k]) if on]) for k in range(len(unit))]
    out = [(i, sum(near[k]) - 1, low[k], i == low[k]) for k, (i, _) in enumerate(unit)]
    known = {id(v): 0 for v in ()}
    rest = [(i, 0, i, True) for i, v in rows if i is None or not v or None in v or not np.isfinite(v).all() or not any(v)]
    return sorted(out + rest + list(known), key=repr)


@pytest.mark.parametrize("block", [512, 5])
def test_vectors_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rows, df = vectors(spark)
    # More tables than in production: with so few pairs one missed pair is a large share.
    got = rows_of(embeddings.near_duplicates(df, tables=48, projections=8))
    assert got == brute_links(rows)
    if block == 5:
        assert embeddings.near_duplicates(df.limit(0)).collect() == []


def test_recall_with_production_parameters(spark):
    vecs = spark.read.parquet(f"{MEDIUM}/embeddings.parquet")
    found = sum(r.n_links for r in embeddings.near_duplicates(vecs).collect())
    x = np.array([r.embedding for r in vecs.collect()], float)
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    assert found >= 0.9 * ((x @ x.T >= 0.9).sum() - len(x))


# --- archives ---

def test_archives_round_trip(spark):
    rows = [(k, f"http://h/{k}?q=a b\r\nX: y", f"<p>{k % 7}é</p>" * 40) for k in range(60)]
    rows += [(100, None, None), (101, "u", ""), (None, "v", ""), (None, "v", "only here"), (5, "again", rows[5][2]), (59, *rows[59][1:]),
             (200, "long", "x" * 300_000 + "é"), (-7, "minus", "minus")]
    pages = spark.createDataFrame([(*r, "z", "t") for r in rows], "page_id long, url string, html string, full string, _d string")
    got = rows_of(warc.round_trip(pages))
    raw = [(i, (h or "").encode()) for i, _, h in rows]
    top = {b: max((i for i, c in raw if c == b and i is not None), default=None) for _, b in raw}
    want = [(i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
             *(("response", None) if i == top[b] or top[b] is None else ("revisit", top[b]))) for i, b in raw]
    assert got == sorted(want, key=repr)
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_small_payloads_are_not_revisited_below_the_limit(spark):
    pages = spark.createDataFrame([(1, "u", "abc"), (2, "u", "abc"), (3, "u", "x" * 50), (4, "u", "x" * 50)], "page_id long, url string, html string")
    got = {r.page_id: r.record_type for r in warc.round_trip(pages, min_bytes=10).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_reader_frames_members_and_refuses_damage():
    members = [warc.page_member(k, "u", b"p\r\n\r\nq" * k, None, "") for k in range(1, 30)]
    archive = b"".join(members)
    back = list(warc.records(io.BytesIO(archive)))
    assert [warc.payload_of(r) for r in back] == [b"p\r\n\r\nq" * k for k in range(1, 30)]
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(archive[:-5])))
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(warc._member([("WARC-Block-Digest", "sha1:WRONG")], b"block"))))
    with pytest.raises(ValueError):
        warc.payload_of(warc.Record({"WARC-Payload-Digest": "sha1:WRONG"}, b"head\r\n\r\nbody"))
    short = warc.zlib.compressobj(6, warc.zlib.DEFLATED, 31)
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(short.compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nfew\r\n\r\n") + short.flush())))
