"""Hard negatives, the filter audit and SentencePiece tokens against brute force and the library."""

import hashlib
import math
import random
import re
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from ledgerline.llm import filteraudit, negatives, pieces

from .edge import EXTRA, documents, rows_of, texts, words

MODEL = public_tokenizers.path("piece_bpe_32k.model")


# --- hard negatives ---

VECTORS = "vec_id long, embedding array<float>, label int, id string, block string, dim string, vector string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, y, "x", "y", "z", "w") for i, v, y in rows], VECTORS)


def odd_vectors(seed=1, n=260, dim=6):
    r = random.Random(seed)
    centres = [[r.gauss(0, 0.4) for _ in range(dim)] for _ in range(4)]
    rows = [(k, [c + r.gauss(0, 0.15) for c in centres[k % 4]], r.randrange(3)) for k in range(n)]
    rows += [(300 + k, list(centres[0]), k % 2) for k in range(40)]  # copies: ties at every rank
    rows += [(400, None, 1), (401, [0.1] * 6, None), (None, [0.2] * 6, 1), (402, [0.1, None, 0.1, 0.1, 0.1, 0.1], 1),
             (403, [math.nan] * 6, 1), (404, [math.inf] + [0.0] * 5, 2), (450, [], 1), (451, [], 2), (452, [], 1),
             (500, [1.0, 2.0], 1), (501, [1.0, 1.9], 1), (502, [0.9, 1.0], 2), (503, [3e38, 0.0], 1), (550, [0.0] * 6, 1)]
    rows += [rows[5], rows[50], (100, [0.3] * 6, 2), (150, [0.0] * 5 + [-1.0], 0)]  # repeated rows; two rows of an id
    return rows


def brute_negatives(rows, positives=5, per=3):
    kept = sorted({(i, y, tuple(math.floor(256 * float(np.float32(c))) for c in v)) for i, v, y in rows
                   if i is not None and y is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)
                   and sum((256.0 * float(np.float32(c))) ** 2 for c in v) < 2 ** 62})
    out = []
    for i, y, v in kept:
        if i % 50:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, z) for j, z, w in kept if j != i and len(w) == len(v))
        for s, j in [(-s, j) for s, j, z in scored if z == y][:positives]:
            near = [(-t, k) for t, k, z in scored if z != y and 50 * s <= -100 * t <= 95 * s]
            out += [(i, j, n + 1, k, s, t) for n, (t, k) in enumerate(near[:per])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("cells", [1 << 18, 60])
def test_negatives_match_brute_force(spark, monkeypatch, cells):
    monkeypatch.setattr(negatives, "CELLS", cells)
    monkeypatch.setattr(negatives, "ANCHOR_CELLS", cells // 2)
    rows = odd_vectors()
    assert rows_of(negatives.mine(vectors(spark, rows), "id % 50 = 0")) == brute_negatives(rows)


def test_negatives_of_an_empty_table(spark):
    assert negatives.mine(vectors(spark, []), "id % 50 = 0").collect() == []
    assert negatives.mine(vectors(spark, [(1, [1.0], 1)]), "id % 50 = 0").collect() == []


def test_vertical_scan_reads_few_columns_of_most_rows():
    """The scan finds the best rows and drops most candidates before it has read all columns."""
    r = np.random.default_rng(4)
    columns = (r.standard_normal((64, 3000)) * 30).astype(np.int64)
    anchor = (r.standard_normal(64) * np.geomspace(200, 1, 64)).astype(np.int64)
    columns[:, :9] = anchor[:, None] + r.integers(-5, 5, (64, 9))
    block = negatives.Block(np.arange(3000), np.zeros(3000, np.int64), columns, columns.min(1), columns.max(1))
    at, scores = negatives.scan(block, anchor, np.ones(3000, bool), 5)
    exact = anchor @ columns
    assert set(np.argsort(-exact, kind="stable")[:5]) <= set(at) and len(at) < 20
    assert (exact[at] == scores).all()
    s = int(np.sort(exact)[-1])
    at, _ = negatives.scan(block, anchor, np.ones(3000, bool), 3, np.array([[s // 4, s // 2]]))
    inside = np.flatnonzero((exact >= s // 4) & (exact <= s // 2))
    assert set(inside[np.lexsort((inside, -exact[inside]))[:3]]) <= set(at)


# --- filter audit ---

def brute_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    parts = {}
    for i, t, lang in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > first[t]}
        parts.setdefault(lang or "", []).append(({f for f in fails if fails[f]}, i in good, i in toxic))
    out = []
    for part, docs in parts.items():
        steps, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = docs
            for k, f in enumerate(order):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                shapley[f] += len(gone)
                failing = [d for d in docs if f in d[0]]
                steps.append((part, "".join(order), k + 1, len(left), len(gone), len(failing) - len(gone),
                              sum(d[0] == {f} for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone)))
        out += [(*s, shapley[s[1][s[2] - 1]]) for s in steps]
    return sorted(out, key=repr)


def audited_rows():
    r = random.Random(8)
    rows = [(i, t, None if i is None else ("en", "fr", "")[i % 3]) for i, t in texts()]
    for k in range(300):
        w = words(9000 + k % 200, 210 if k % 3 else 20)
        if k % 4 == 0:
            w = w[:40] * 6
        if k % 5 == 0:
            w = [x.title() for x in w]
        if k % 7 == 0:
            w.append("50%")
        rows.append((1000 + r.randrange(280), " ".join(w), r.choice(["en", "fr", None])))
    return rows


LABELS = "doc_id long, quality int, toxic int, part string, row string"


@pytest.mark.parametrize("width", [1 << 15, 16])
def test_audit_matches_brute_force(spark, monkeypatch, width):
    monkeypatch.setattr(filteraudit, "RANGE", width)
    rows = audited_rows()
    r = random.Random(2)
    labels = [(r.randrange(1000, 1300), r.choice([0, 1, None]), r.choice([0, 1])) for _ in range(200)] + [(None, 1, 1), (1, 1, None), (1, 0, 1)]
    docs = spark.createDataFrame([(i, t, g, *["x"] * len(EXTRA)) for i, t, g in rows], "doc_id long, text string, lang string, "
                                 + ", ".join(f"`{c}` string" for c in EXTRA))
    marks = spark.createDataFrame([(*x, "p", "r") for x in labels], LABELS)
    columns = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert rows_of(filteraudit.audit(docs, marks).select(columns)) == brute_audit(rows, labels)


def test_audit_of_an_empty_table_and_without_labels(spark):
    none = spark.createDataFrame([], LABELS)
    assert filteraudit.audit(documents(spark, []), none).collect() == []
    assert filteraudit.audit(documents(spark, [(None, None)]), none).count() == 600


def test_galloping_merges():
    r = random.Random(6)
    for _ in range(300):
        lists = [sorted(r.sample(range(60), r.randint(0, 40))) for _ in range(r.randint(0, 4))]
        x = sorted(r.sample(range(60), r.randint(0, 50)))
        assert filteraudit.union(lists) == sorted(set().union(*lists))
        gone = filteraudit.union(lists)
        assert filteraudit.difference(x, gone) == sorted(set(x) - set(gone))
        assert filteraudit.common(x, gone) == len(set(x) & set(gone))


# --- SentencePiece ---

@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def table():
    return pieces.PrefixTable(pieces.read_model(MODEL))


def test_tokens_equal_the_library_on_odd_texts(table, library):
    r = random.Random(3)
    alphabet = [*"abcdeforst   ▁\n\t\x00Éé中日本語😀ﬁ#0123​�", "     ", "the ", "ing", "tion "]
    for _ in range(1500):
        text = "".join(r.choice(alphabet) for _ in range(r.randint(0, 60)))
        ids = table.encode(text).tolist()
        assert ids == library.encode(text), text


def test_any_ids_decode_as_in_the_library(library):
    decoder = pieces.Decoder(pieces.read_model(MODEL))
    r = random.Random(5)
    for _ in range(2000):
        ids = [r.choice([r.randrange(32000), r.randrange(300), r.randrange(3, 259)]) for _ in range(r.randint(0, 8))]
        assert decoder.decode(np.array(ids, int)) == library.decode(ids), ids


def test_each_prefix_has_its_own_last_token(table, library):
    """The table's entry of a prefix is the last token of that prefix encoded alone."""
    text = "▁" + "internationalisation" + "xyzzy" + "aaaaaaa"
    last = table.last_tokens(text)
    for end in range(2, len(text) + 1):
        assert last[end - 1] == library.encode(text[1:end])[-1]


def test_stores_may_overflow(library, monkeypatch):
    monkeypatch.setattr(pieces, "WORDS", 5)
    monkeypatch.setattr(pieces, "PAIRS", 3)
    table = pieces.PrefixTable(pieces.read_model(MODEL))
    text = " ".join(words(31, 300))
    assert table.encode(text).tolist() == library.encode(text)
    assert len(table.words) <= 300 and len(table.pairs) <= 3 and len(table.lockstep.keys) <= 2000


def test_long_chunk_in_linear_time(table, library):
    text = "".join(random.Random(1).choice("abcdef") for _ in range(100_000))
    assert table.encode(text).tolist() == library.encode(text)


def _varint(n):
    return bytes([n & 127 | 128]) + _varint(n >> 7) if n > 127 else bytes([n])


def _message(*fields):
    return b"".join(_varint(k << 3 | (0 if isinstance(v, int) else 2)) + (_varint(v) if isinstance(v, int) else _varint(len(v)) + v)
                    for k, v in fields)


def _model_file(tmp_path, names, trainer, normalizer):
    """A model file of unknown, control and scored pieces; all scores are equal, so only places decide."""
    listed = [_message((1, b"<unk>"), (3, 2)), _message((1, b"<s>"), (3, 3)), *[_message((1, n.encode())) + b"\x15" + b"\0" * 4 for n in names]]
    path = tmp_path / "m.model"
    path.write_bytes(_message(*[(1, p) for p in listed], (2, _message(*trainer)), (3, _message(*normalizer))))
    return str(path)


def test_model_of_equal_scores_without_bytes_or_single_characters(tmp_path):
    """Ties go to the left, marks may lie inside pieces, neighbouring unknown characters are one token."""
    names = ["ab", "ba", "aa", "aba", "b", "a▁", "a▁b", "▁", "cd"]  # a, c and d are no pieces of their own
    path = _model_file(tmp_path, names, [(3, 2)], [(3, 1), (4, 0), (5, 1)])
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    table, decoder = pieces.PrefixTable(pieces.read_model(path)), pieces.Decoder(pieces.read_model(path))
    r = random.Random(2)
    for _ in range(800):
        text = "".join(r.choice("aabb cdx") for _ in range(r.randint(0, 12)))
        ids = table.encode(text).tolist()
        assert ids == library.encode(text), text
        assert decoder.decode(np.array(ids, int)) == library.decode(ids), text


def test_other_models_are_refused(tmp_path):
    for trainer, normalizer in (([(3, 1)], [(4, 0)]), ([(3, 2)], [(4, 1)]), ([(3, 2)], [(2, b"map"), (4, 0)])):
        with pytest.raises(ValueError):
            pieces.read_model(_model_file(tmp_path, ["a"], trainer, normalizer))


def test_documents_encode_and_decode(spark, library):
    rows = texts()
    out = rows_of(pieces.report(documents(spark), MODEL))
    expected = []
    for i, t in rows:
        ids = library.encode(t or "")
        expected.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert out == sorted(expected, key=repr)
    assert pieces.report(documents(spark, []), MODEL).collect() == []


def test_encode_keeps_columns_and_decode_gives_the_text_back(spark):
    model = pieces.read_model(MODEL)
    docs = documents(spark).withColumnRenamed("th", "ids")  # a column of the name that is written
    coded = pieces.encode(docs, model)
    assert [c for c in docs.columns if c != "ids"] + ["ids"] == coded.columns
    back = pieces.decode(coded, model)
    assert all(r.decoded == (r.text or "") for r in back.select("text", "decoded").collect())
    empty = pieces.decode(spark.createDataFrame([(None,), ([],)], "ids array<int>"), model)
    assert [r.decoded for r in empty.collect()] == ["", ""]
