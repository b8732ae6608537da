"""Operators on documents: odd rows, and small tables against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from roasty.llm import decontamination, jaccard_join, pieces, quality, shingling, suffix_dedup
from roasty.llm.components import components
from roasty.llm.oracle_sql import OP1, OP4, OP8
from roasty.llm.queries import QUERIES

from .conftest import CLASHING, TEXTS

SPACE = r"[^\x20\x09-\x0D]+"


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def by_duckdb(sql, documents, benchmark=None):
    con = duckdb.connect()
    con.register("documents", documents)
    if benchmark is not None:
        con.register("benchmark", benchmark)
    return con.execute(sql).fetchall()


def frame(data, columns):
    return pd.DataFrame(data, columns=columns).astype(object).where(lambda d: d.notna(), None)


def corpus(seed=5, n=60):
    """Texts with copies, edited copies, shared passages and repeats."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 6))) for _ in range(150)]
    say = lambda k: " ".join(r.choice(vocab) for _ in range(k))
    passage, out = say(90), []
    for _ in range(n):
        kind = r.random()
        if kind < 0.2 and out:
            t = r.choice(out)
        elif kind < 0.5 and out:
            w = r.choice(out).split(" ")
            for _ in range(max(1, len(w) // 40)):
                w[r.randrange(len(w))] = r.choice(vocab)
            t = " ".join(w)
        elif kind < 0.7:
            t = f"{say(r.randint(5, 60))} {passage} {say(r.randint(0, 60))}"
        elif kind < 0.8:
            t = (say(12) + "\n") * 4 + "#$%" * r.randint(0, 40)
        else:
            t = say(r.randint(1, 200))
        out.append(t)
    return [(i * 3, t) for i, t in enumerate(out)]


# Quality rules.


def test_quality_odd_rows(edge_docs, no_docs):
    got = {(r.doc_id, r.n_words): r for r in quality.judge(edge_docs).collect()}
    assert quality.judge(edge_docs).count() == len(TEXTS)
    for i in (3, 4, 5):
        assert got[i, 0].base_failed and not got[i, 0].kept and got[i, 0].word_chars == 0
    assert got[6, 6000].kept and got[8, len(TEXTS[-1][1].split())].word_chars == sum(len(w) for w in TEXTS[-1][1].split())
    assert got[1, 45].base_failed and got[1, 45].n_repeat_words == 45
    kept = quality.keep(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "2", "6", "8", "None"]
    assert quality.judge(no_docs).count() == 0 and quality.keep(no_docs).count() == 0


def test_quality_against_sql(spark):
    r = random.Random(2)
    data = [(i, t, r.choice(["en", "de", None]), r.choice(["s0", "s1"])) for i, t in corpus(n=300)]
    data += [(10_000 + i, "##$$ " * 40 + t, "en", "s0") for i, t in corpus(9, 5)]
    columns = ["doc_id", "text", "lang", "source"]
    got = quality.judge(spark.createDataFrame(data, "doc_id long, text string, lang string, source string")).drop("text_key")
    assert rows(got) == sorted(by_duckdb(OP1, frame(data, columns)), key=str)
    assert {x.kept for x in got.filter("NOT base_failed").collect()} == {True, False}


def test_quality_sketches_merge(spark):
    measured = quality.ratios(
        spark.createDataFrame([(s, 100, 500, i % 7, 10, 0, 0) for i in range(50) for s in "ab"],
                              "source string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"))
    fine = quality.sketch(measured, ["source"])
    assert rows(quality.merge(fine, []).select("ratio", "at", "n")) == rows(quality.sketch(measured, []).select("ratio", "at", "n"))


# Suffix-array dedup.


def brute_dedup(docs, length=400, least_words=0):
    seen, raws = Counter(), [(t or "").encode() for _, t in docs]
    for raw in raws:
        seen.update(raw[k : k + length] for k in range(len(raw) - length + 1))
    out = []
    for (i, _), raw in zip(docs, raws, strict=True):
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            if seen[raw[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        for run in re.finditer(b"\1+", bytes(gone)):
            if len(raw[run.start() : run.end()].split()) < least_words:
                gone[run.start() : run.end()] = bytes(run.end() - run.start())
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("group", [20_000, 3])
def test_suffix_dedup_against_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    docs = corpus(n=70) + [(900, "ab" * 500), (901, "x" * 399), (902, "x" * 400), (903, "y" * 401), (904, None), (905, ""), (906, "ab" * 260)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert rows(suffix_dedup.dedup(df)) == brute_dedup(docs)
    assert rows(suffix_dedup.dedup(df, length=150)) == brute_dedup(docs, 150)


def test_passages_by_words(spark):
    """Of shared runs those with too few words stay, whatever their bytes."""
    docs = corpus(31, 50)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    left = {r.doc_id: r.text for r in suffix_dedup.remove_duplicates(df, length=150, least_words=40).collect()}
    want = {i: sha for i, *_, sha in brute_dedup(docs, 150, 40)}
    some = {i for i, t in left.items() if t == dict(docs)[i]}
    assert 0 < len(some) < len(left) and brute_dedup(docs, 150, 40) != brute_dedup(docs, 150)
    for i, t in left.items():  # a character that loses a byte goes whole
        assert hashlib.sha256(t.encode()).hexdigest() == want[i] or not t.isascii()


def test_suffix_dedup_odd_rows(edge_docs, no_docs):
    assert rows(suffix_dedup.dedup(edge_docs)) == brute_dedup(TEXTS)
    cut = suffix_dedup.remove_duplicates(edge_docs, length_col="n_chars")
    assert cut.columns == edge_docs.columns and cut.count() == len(TEXTS)
    twice = suffix_dedup.remove_duplicates(edge_docs.unionByName(edge_docs))
    assert 6 not in {r.doc_id for r in twice.collect()}  # nothing is left of either copy
    assert suffix_dedup.dedup(no_docs).count() == 0 and suffix_dedup.remove_duplicates(no_docs).count() == 0


def test_suffix_query_returns_what_is_left(spark, tmp_path):
    """The text without its repeated strings, whole for all others; of two
    characters that share a byte with a string, the rest goes too."""
    passage = "".join(chr(97 + k * k % 23 * k % 26) for k in range(500))
    docs = [(1, f"one {passage}é end"), (2, f"two, later: {passage}è, done"), (3, "clean é text " * 3), (4, passage[:399]), (5, None), (6, "")]
    docs += [(7, "same text " * 60), (7, "same text " * 60)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    done = QUERIES["op2_suffix_array_dedup"](spark, str(tmp_path))
    assert done.columns[:5] == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert rows(done.drop("text")) == brute_dedup(docs)
    left = {1: "one end", 2: "two, later:, done", 3: docs[2][1], 4: passage[:399], 5: "", 6: "", 7: ""}
    assert {r.doc_id: r.text for r in done.collect()} == left


def test_suffix_sort_survives_hash_collisions(monkeypatch):
    """Hashes that all agree: extensions are then found on the bytes."""
    monkeypatch.setattr(suffix_dedup.Stretches, "_same", lambda *a: True)
    s = suffix_dedup.Stretches([b"xxabcdef", b"yxabcdzz"], [2, 2])
    assert (s.right(0, 1), s.left(0, 1)) == (4, 1)


# Pieces.


def test_pieces_are_the_librarys(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    with open(pieces.MODEL_PATH, "rb") as f:
        model = f.read()
    sp, v = sentencepiece.SentencePieceProcessor(model_proto=model), pieces.Vocabulary.from_model(model)
    r = random.Random(1)
    texts = ["", " ", "a  b", "\n\n x", "Hello world", "日本 😀 é"] + [t for _, t in corpus()]
    texts += ["".join(r.choice(" \n\tabehtinghé漢😀<s>") for _ in range(80)) for _ in range(200)]
    for t, coded in zip(texts, v.encode_texts(texts), strict=True):
        ids = np.frombuffer(coded, "<i4").tolist()
        assert ids == sp.encode(t)
        assert v.decode(ids) == t


def test_unigram_pass_finds_the_best_sum():
    r = random.Random(3)
    vocab = {c: (i, -5.0 - r.random()) for i, c in enumerate("abc▁")}
    for i in range(30):
        p = "".join(r.choice("abc") for _ in range(r.randint(2, 4)))
        vocab.setdefault(p, (10 + i, -4 * r.random() - 2))
    v = pieces.Vocabulary(vocab, "unigram", None, 99)

    def best(word):
        if not word:
            return 0.0
        return max(vocab[word[:k]][1] + best(word[k:]) for k in range(1, 5) if word[:k] in vocab)

    words = {"".join(r.choice("abc") for _ in range(r.randint(1, 9))) for _ in range(150)}
    names = {i: p for p, (i, _) in vocab.items()}
    for word, ids in v.encode_words(words).items():
        assert "".join(names[i] for i in ids) == word
        assert sum(vocab[names[i]][1] for i in ids) == pytest.approx(best(word))


def test_pieces_caches_start_anew(monkeypatch):
    monkeypatch.setattr(pieces, "CACHED_WORDS", 40)
    monkeypatch.setattr(pieces, "CACHED_PAIRS", 10)
    with open(pieces.MODEL_PATH, "rb") as f:
        model = f.read()
    small, large = pieces.Vocabulary.from_model(model), pieces.Vocabulary.from_model(model)
    texts = [t for _, t in corpus(8, 40)]
    monkeypatch.setattr(pieces, "CACHED_WORDS", 40)
    one_by_one = [small.encode_texts([t])[0] for t in texts]
    monkeypatch.setattr(pieces, "CACHED_WORDS", 10**6)
    assert one_by_one == large.encode_texts(texts)


def test_pieces_of_a_batch_handle_each_word_once(monkeypatch):
    sentencepiece = pytest.importorskip("sentencepiece")
    with open(pieces.MODEL_PATH, "rb") as f:
        model = f.read()
    sp, v = sentencepiece.SentencePieceProcessor(model_proto=model), pieces.Vocabulary.from_model(model)
    seen = []
    monkeypatch.setattr(v, "_cut", lambda words: (seen.extend(words), v._cut_bpe(words))[1])
    texts = ["left out", " ends in space ", None, "", " begins  so", "▁a mark", "two\n\nlines \n of", "漢字 é😀", "ends in space", "left out"]
    flat, ends = v.encode_array(pa.array(texts, pa.string()).slice(1, 8))
    for t, a, b in zip(texts[1:9], ends[:-1], ends[1:], strict=True):
        assert flat[a:b].tolist() == sp.encode(t or "")
    assert len(seen) == len(set(seen)) and "▁in" in seen and "▁left" not in seen
    for nothing in ([], [None, ""]):
        flat, ends = v.encode_array(pa.array(nothing, pa.string()))
        assert len(flat) == 0 and ends.tolist() == [0] * (len(nothing) + 1)


@pytest.mark.parametrize("kind", ["bpe", "unigram"])
@pytest.mark.parametrize("byte_ids", [None, list(range(300, 556))])
def test_pieces_of_characters_without_one(kind, byte_ids):
    vocab = {p: (i, -10 - i / 10) for i, p in enumerate(["a", "b", "▁", "ab", "▁ab"])}
    v = pieces.Vocabulary(vocab, kind, byte_ids, 99)
    other = [300 + b for b in "é".encode()] if byte_ids else [99]
    texts = ["ab éab ab", "ab", "é", ""]
    want = [[4, 2, *other, 3, 4], [4], [2, *other], []]
    assert [np.frombuffer(c, "<i4").tolist() for c in v.encode_texts(texts)] == want
    assert v.encode_words(["▁éab", "▁ab"]) == {"▁ab": [4], "▁éab": [2, *other, 3]}


def test_pieces_odd_rows(edge_docs, no_docs):
    coded = pieces.encode(edge_docs)
    assert set(coded.columns) == {*edge_docs.columns, "round_trip"}
    for r in coded.collect():
        assert r.round_trip and bool(r.pieces) == bool(r.text) and r._row == "_row"
    back = pieces.decode(coded).collect()
    assert all(r.decoded == (r.text or "") for r in back) and len(back) == len(TEXTS)
    assert pieces.encode(no_docs).count() == 0


# Jaccard join.


def brute_components(docs):
    sets, parent = [], {}
    for i, t in docs:
        w = re.findall(SPACE, low(t))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(docs)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    shared = defaultdict(int)
    having = defaultdict(list)
    for k, s in enumerate(sets):
        for g in s:
            for other in having[g]:
                shared[other, k] += 1
            having[g].append(k)
    for (a, b), o in shared.items():
        if 100 * o >= 80 * (len(sets[a]) + len(sets[b]) - o):
            parent[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    return sorted([(i, len(s), least.get(top(k)) if s else i) for k, ((i, _), s) in enumerate(zip(docs, sets, strict=True))], key=str)


@pytest.mark.parametrize("way", ["as is", "hot", "some hot", "many classes"])
def test_jaccard_against_brute_force(spark, monkeypatch, way):
    if way == "hot":  # every shingle takes the way of the frequent ones
        monkeypatch.setattr(jaccard_join, "RARE", 0)
    if way == "some hot":  # more frequent shingles than tasks are sent, many deals
        monkeypatch.setattr(jaccard_join, "RARE", 1)
        monkeypatch.setattr(jaccard_join, "MOST_FREQUENT", 200)
        monkeypatch.setattr(jaccard_join, "HELD", 500)
    if way == "many classes":
        monkeypatch.setattr(jaccard_join, "FEW_CLASSES", 0)
    docs = corpus(11, 120) + [(5000, "a b c"), (5001, "A B c"), (5002, "a b c d"), (5003, ""), (5004, None), (5005, "  ")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = rows(jaccard_join.near_duplicates(df).drop("text_key", "node"))
    assert got == brute_components(docs)
    assert got == sorted(by_duckdb(OP4, frame(docs, ["doc_id", "text"])), key=str)


def test_jaccard_of_a_large_group(spark, monkeypatch):
    """Copies with so many changes that some reach each other only through
    others: every list holds the whole group."""
    monkeypatch.setattr(jaccard_join, "RARE", 8)
    r = random.Random(9)
    base = [f"w{r.randrange(10**6)}" for _ in range(120)]
    docs = []
    for i in range(150):
        w = list(base)
        for _ in range(r.randrange(6)):
            w[r.randrange(120)] = f"x{r.randrange(10**6)}"
        docs.append((i, " ".join(w)))
    got = rows(jaccard_join.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).drop("text_key", "node"))
    assert got == brute_components(docs) and len({c for _, _, c in got}) > 1


def test_packed_columns_round_trip():
    r = np.random.default_rng(1)
    for width, n in ((5, 0), (5, 1000), (8, 300), (4, 7)):
        v = np.sort(r.integers(0, 256**width - 1, n, np.uint64, endpoint=True))
        assert (shingling.unpack_sorted(shingling.pack_sorted(v, width), width) == v).all()
        assert (shingling.unpack(shingling.pack(v[::-1], width), width) == v[::-1]).all()


def test_jaccard_links_chains(spark):
    """Each text is close to the next one only; all are one component."""
    r = random.Random(4)
    w = [f"v{r.randrange(10**6)}" for _ in range(200)]
    docs = []
    for i in range(30):
        docs.append((100 - i, " ".join(w)))
        for k in range(3):
            w[(i * 3 + k) * 11 % 200] = f"n{i}x{k}"
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = rows(jaccard_join.near_duplicates(df).drop("text_key", "node"))
    assert got == brute_components(docs) and {c for _, _, c in got} == {71}


def test_jaccard_odd_rows(edge_docs, no_docs):
    assert rows(jaccard_join.near_duplicates(edge_docs).drop("text_key", "node")) == brute_components(TEXTS)
    kept = jaccard_join.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    assert Counter(str(r.doc_id) for r in kept.collect()) == Counter(["1", "2", "2", "3", "4", "5", "6", "7", "None", "8"])
    assert jaccard_join.near_duplicates(no_docs).count() == 0 and jaccard_join.keep_one(no_docs).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "u long, v long")
    assert rows(components(edges)) == sorted([(i, 0) for i in range(1, 41)] + [(101, 100)], key=str)


# Benchmark decontamination.


def test_decontamination_against_sql(spark):
    r = random.Random(6)
    docs = corpus(13, 80)
    items = []
    for i in range(12):
        w = r.choice(docs)[1].split()
        at = r.randrange(max(1, len(w) - 20))
        items.append((i, " ".join(w[at : at + r.choice([1, 3, 9, 10, 11, 25])]).upper() + " ."))
    items += [(50, ""), (51, "?!"), (52, items[0][1])]
    got = decontamination.score(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    want = by_duckdb(OP8, frame(docs, ["doc_id", "text"]), frame(items, ["item_id", "text"]))
    assert rows(got.drop("spans")) == sorted(want, key=str)
    assert any(w[-1] for w in want) and not all(w[-1] for w in want)


def test_decontamination_by_shuffle(spark, monkeypatch):
    docs = spark.createDataFrame(corpus(13, 40), "doc_id long, text string")
    items = spark.createDataFrame(corpus(13, 40)[:3], "item_id long, text string")
    held = rows(decontamination.score(docs, items))
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 0)
    assert rows(decontamination.score(docs, items)) == held


def test_decontamination_by_shuffle_moves_no_document_a_run(spark, monkeypatch, edge_docs):
    long = " ".join(f"w{i * 7919 % 100_003}" for i in range(60_000))
    docs = spark.createDataFrame([(1, long), (1, long), (None, long), (2, "w0 w1")], "doc_id long, text string")
    words = long.split()
    items = spark.createDataFrame([(1, " ".join(words[30_000:30_040])), (2, " ".join(words[30_005:30_015])), (3, "w0 w1")], "item_id long, text string")
    held = rows(decontamination.score(docs, items)), rows(decontamination.score(edge_docs, items.union(edge_docs.select("doc_id", "text"))))
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = decontamination.score(docs, items)
        # Each sampled run drops the array of words from its row.
        made = re.findall(r"Generate posexplode.*", got._jdf.queryExecution().optimizedPlan().toString())
        assert made and all(re.search(r"posexplode\(.*\), \[\d+\]", g) for g in made)
        assert rows(got) == held[0]
        assert rows(decontamination.score(edge_docs, items.union(edge_docs.select("doc_id", "text")))) == held[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(r[2:4] for r in held[0]) == [(2, 1), (40, 2), (40, 2), (40, 2)]


def test_decontamination_broadcasts_by_bytes(spark, monkeypatch):
    items = spark.createDataFrame([(i, "one text of ten words that all of them share") for i in range(500)], "item_id long, text string")
    grams = decontamination.benchmark_windows(items)
    assert decontamination._measured(grams)[3]
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", 1000)  # the words fit, their items do not
    _, of, lengths, broadcast = decontamination._measured(grams)
    assert broadcast and lengths == [10] and "ResolvedHint" not in of._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", 100)
    assert not decontamination._measured(grams)[3]


def test_decontamination_odd_rows(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(None, "quick brown fox jumps over the lazy dog near the old"), (2, None)], "item_id long, text string")
    got = {r.doc_id: r for r in decontamination.score(edge_docs, items).collect()}
    assert got[1].contaminated and got[1].n_hit == 33 and got[1].n_items == 1 and got[3].n_words == 0
    assert got[1].items_sha256 == hashlib.sha256(b"").hexdigest()
    kept = decontamination.decontaminate(edge_docs, items)
    assert kept.columns == edge_docs.columns and kept.count() == len(TEXTS) - 1
    cut = {r.doc_id: r for r in decontamination.decontaminate(edge_docs, items, mode="spans").collect()}
    assert cut[1].text == "The " + "river bank today. The " * 2 + "river bank today. " and cut[6].text == TEXTS[6][1]
    none = items.filter("false")
    assert decontamination.score(edge_docs, none).filter("contaminated").count() == 0
    assert decontamination.score(no_docs, items).count() == 0 and decontamination.decontaminate(no_docs, none).count() == 0
    assert set(CLASHING) <= set(cut[1].asDict())
