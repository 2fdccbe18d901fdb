"""The divergence audit, chat formatting and centroid clustering against brute force."""

import hashlib
import re
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given as drawn
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paneloom.llm import centroids, chat, divergence
from paneloom.llm.queries import llm_oracles, llm_queries

FOLDER = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables are absent")


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


@given
@pytest.mark.parametrize("name", ["op11_source_divergence", "op12_chat_formatting", "op13_centroid_clustering"])
def test_queries_agree_with_their_sql(spark, name):
    database = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    want = database.execute(llm_oracles()[name]).fetch_df()
    got = llm_queries()[name](spark, FOLDER).toPandas()[list(want.columns)]
    assert sorted(map(repr, got.itertuples(index=False))) == sorted(map(repr, want.itertuples(index=False)))


# ----------------------------------------------------------------------------------------- op11

WORDS = "alpha Beta GAMMA delta éclair Éclair naïve Σίσυφος 한국어 x1y don't".split()


def divergences(rows, least=10, top=10):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = {c: c + 32 for c in range(65, 91)}
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = term.findall((text or "").translate(lower))
        groups.add((lang, source))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= least]
        v = len(kept)

        def shares(own):
            whole = sum(own[t] for t in kept) + 2 * v
            return {t: 1 + 10**9 * (own[t] + 2) // whole for t in kept}

        everything = sum((counts[g] for g in groups if g[0] == lang), Counter())
        p, q = shares(counts[lang, source]), shares(everything)
        far = lambda a, b: (a - b) ** 2 // (a + b)
        pairs = [(sum(far(p[t], o[t]) for t in kept), s) for l, s in groups if l == lang and s != source for o in [shares(counts[lang, s])]]
        terms = [(far(p[t], q[t]), t) for t in kept if counts[lang, source][t] and p[t] > q[t]]
        for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
            items.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(items[:most])]
    return sorted(out, key=repr)


def divergence_rows():
    rng = np.random.default_rng(3)
    rows = [(None, None, None), ("", "en", "empty"), ("...", "en", ""), ("alpha " * 40_000, "en", "long"), ("z" * 100_000, "de", "s1")]
    for i in range(400):
        words = rng.choice(WORDS, size=int(rng.integers(0, 30)), p=rng.dirichlet(np.ones(len(WORDS)) * 0.5))
        rows.append((" ".join(words), [None, "en", "de", "fr"][i % 7 % 4], None if i % 11 == 0 else f"s{i % 5 if i % 3 else 0}"))
    return rows + rows[50:60]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(7)
    return df.withColumns({c: F.lit("extra") for c in ("term", "docs", "tile", "chunk", "rank", "Value", "total")})


def test_divergences_equal_brute_force(spark):
    rows = divergence_rows()
    assert found(divergence.source_divergences(frame(spark, rows))) == divergences(rows)
    assert found(divergence.source_divergences(frame(spark, rows), least_docs=1, top_terms=2)) == divergences(rows, 1, 2)
    assert divergence.source_divergences(frame(spark, rows).where("false")).count() == 0


def test_divergences_with_spills_tiles_and_chunks(spark, monkeypatch):
    """Small units in the driver's plan (tiles, chunks): the same rows."""
    rows = divergence_rows()
    want = divergences(rows, 2)
    monkeypatch.setattr(divergence, "TILE", 2)
    monkeypatch.setattr(divergence, "CELLS", 16)
    assert found(divergence.source_divergences(frame(spark, rows), least_docs=2)) == want


def test_spilled_stripes_merge_to_the_same(monkeypatch):
    rows = divergence_rows()
    batch = pa.RecordBatch.from_pydict({c: [r[i] or "" for r in rows] for i, c in ((1, "lang"), (2, "source"), (0, "text"))})

    def merged(spill):
        monkeypatch.setattr(divergence, "SPILL_BYTES", spill)
        parts = list(divergence._fold(batch.slice(i, 13) for i in range(0, batch.num_rows, 13)))
        table = pa.Table.from_batches(parts).sort_by([("lang", "ascending"), ("term", "ascending")])
        out = []
        for b in divergence._merge(3)(iter(table.to_batches(max_chunksize=5))):
            out += [(r["lang"], r["term"], r["docs"], sorted(zip(r["sources"], r["counts"]))) for r in b.to_pylist()]
        return len(parts), out

    few, one = merged(1 << 40)
    many, other = merged(2000)
    assert many > few and one == other and len({r[:2] for r in one}) == len(one)


def test_shares_are_exact_for_large_counts():
    rng = np.random.default_rng(1)
    whole = rng.integers(10, 9 * 10**15, 2000)
    counts = (whole * rng.random(2000) ** 3).astype(np.int64)
    want = [1 + 10**9 * (int(c) + 2) // int(w) for c, w in zip(counts, whole)]
    assert divergence.shares(counts, whole).tolist() == want


# ----------------------------------------------------------------------------------------- op12

PARTS = ["<", "[", "\\", "/", "INST]", "[INST]", "</s>", "<s>", "<<SYS>>", "<</SYS>>", "[/ROLE]", "[ROLE]", " ", "\n", "s>", "SYS>>", "é", "😀", "ok"]
SAID = st.lists(st.sampled_from(PARTS), max_size=12).map("".join)
TURN = st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", "", "tool"]), SAID), SAID)


@settings(max_examples=400, deadline=None)
@drawn(st.lists(TURN, max_size=6))
def test_rendered_turns_come_back(turns):
    text, loss = chat.render(turns)
    assert chat.parse(text) == (turns, loss)
    assert [chat.unescape(text[a:b]) for a, b in loss] == [t for r, t in turns if r == "assistant"]


@settings(max_examples=400, deadline=None)
@drawn(SAID)
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    once = chat.escape(text)
    assert chat.unescape(once) == text
    assert not re.search(r"\[/?(INST|ROLE)\]|</?s>|<</?SYS>>", once)


def test_only_conflicting_turns_are_escaped():
    turns = [("user", "a < b [x]"), ("assistant", "</s>[INST] ok [/INST]"), ("user", "c\\d")]
    text, _ = chat.render(turns)
    assert text == "<s>[INST] a < b [x] [/INST]</s>\n<s> <\\/s>[\\INST] ok [\\/INST] </s>\n<s>[INST] c\\d [/INST]</s>\n"
    with pytest.raises(ValueError):
        chat.parse(text[:-3])
    with pytest.raises(ValueError):
        chat.parse("<s>[INST] a [/INST] b </s>\n")


def chat_rows():
    rows = [
        (1, 2, "assistant", "third"), (1, 0, "system", None), (1, 1, "user", ""), (None, 0, "user", "no id"), (None, None, None, None),
        (2, 0, "user", "same"), (2, 0, "user", "same"), (2, 0, "assistant", "tie"), (3, 0, "tool", "[/ROLE] x"), (4, 0, "assistant", "w" * 300_000),
        (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]"),
    ]
    rows += [(7, i, "assistant" if i % 2 else "user", f"{i} <s>[INST] é😀" * (i % 4)) for i in range(900)]  # a hot conversation
    return rows + [(100 + i, j, "user" if j % 2 == 0 else "assistant", f"{i} {j}") for i in range(60) for j in range(3)]


def chats(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    return df.withColumns({c: F.lit("extra") for c in ("piece", "whole", "loss", "hash", "n_turns")})


def digests(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    out = []
    for conv, turns in own.items():
        turns = [(r, t) for _, _, r, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        out.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(chat.render(turns)[0])))
    return sorted(out, key=repr)


@pytest.mark.parametrize("piece", [1 << 20, 50])
def test_digests_read_back_equal_brute_force(spark, monkeypatch, piece):
    rows = chat_rows()
    if piece == 50:  # a conversation in many pieces
        batch = pa.RecordBatch.from_pydict({"conv_id": [r[0] for r in rows[12:]], "role": [r[2] for r in rows[12:]], "text": [r[3] for r in rows[12:]]})
        monkeypatch.setattr(chat, "PIECE_CHARS", piece)
        pieces = pa.Table.from_batches(list(chat._format(iter([batch]))))
        back = [tuple(r.values()) for b in chat._digest(iter(pieces.to_batches())) for r in b.to_pylist()]
        assert pieces.num_rows > 400 and sorted(back, key=repr) == digests(rows[12:])
        assert [r["whole"] for r in pieces.to_pylist()].count(True) == 59
        return
    assert found(chat.formatted_digests(chats(spark, rows))) == digests(rows)
    assert chat.formatted_digests(chats(spark, rows).where("false")).count() == 0


def test_a_hot_conversation_is_cut_by_ranges_and_reads_as_one(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows make one partition
    try:
        formatted = chat.format_chats(chats(spark, chat_rows())).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    hot = sorted((r for r in formatted if r.conv_id == 7), key=lambda r: r.piece)
    turns = [t for r in hot for t in chat.parse(r.text)[0]]
    assert len(hot) > 1 and turns == [(r, t) for c, _, r, t in chat_rows() if c == 7]
    for r in hot:
        assert chat.parse(r.text)[1] == [(x.start, x.end) for x in r.loss]


# ----------------------------------------------------------------------------------------- op13


def lloyd(rows, size, k=8, rounds=10):
    """Plain rounds over whole numbers of any size."""
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), np.array(v, "<i4").tobytes(), v) for i, v in kept)[:k]
    centers = [v for _, _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centers))

    for r in range(rounds + 1):
        own = [nearest(v) for _, v in kept]
        if r < rounds:
            members = defaultdict(list)
            for (_, v), (_, j) in zip(kept, own):
                members[j].append(v)
            centers = [[sum(x) // len(members[j]) for x in zip(*members[j])] if members[j] else c for j, c in enumerate(centers)]
    inertia = Counter()
    for d, j in own:
        inertia[j] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), sha[j]) for (i, _), (d, j) in zip(kept, own)), key=repr)


def vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    return df.withColumns({c: F.lit("extra") for c in ("cluster", "vector", "due", "was", "label", "Distance")})


@pytest.mark.parametrize("spread", [0.02, 0.5])
def test_clusters_equal_plain_rounds(spark, spread):
    """Awkward vectors, copies, ties and repeated ids; apart clusters, of which few vectors are scanned again, and a cloud."""
    rng = np.random.default_rng(5)
    places = rng.normal(size=(5, 6))
    rows = [(i, (places[i % 5] + spread * rng.normal(size=6)).tolist()) for i in range(500)]
    rows += [(600 + i, rows[0][1]) for i in range(200)] + [rows[3], (None, rows[9][1]), (700, rows[8][1])]
    rows += [(800, None), (801, []), (802, [1.0]), (803, [None] * 6), (804, [float("nan")] * 6), (805, [float("inf")] + [0.0] * 5), (806, [0.0] * 6)]
    report = {}
    got = found(centroids.cluster_vectors(vectors(spark, rows), size=6, report=report))
    assert got == lloyd(rows, 6)
    assert len(report["scanned"]) == 11 and report["scanned"][0] == 704
    if spread < 0.1:
        assert sum(report["scanned"][1:]) < 704 * 8


def test_few_equal_large_and_no_vectors(spark):
    for rows, size in (
        ([(1, [1.0, 2.0])], 2),
        ([(i, [0.5, -0.5]) for i in range(20)], 2),
        ([(i, [float(i), 0.0]) for i in (0, 2, 1)], 2),
        ([(i, [(-1) ** i * 100_000.0 + i * 0.01, 60_000.0 * (i % 3)]) for i in range(40)], 2),
    ):
        assert found(centroids.cluster_vectors(vectors(spark, rows), size=size)) == lloyd(rows, size)
    empty = vectors(spark, [(1, None)])
    assert centroids.cluster_vectors(empty).count() == 0 and centroids.cluster_vectors(empty.where("false")).count() == 0
    with pytest.raises(Exception, match="don't fit in a long"):
        centroids.cluster_vectors(vectors(spark, [(1, [1e30, 0.0])]), size=2).count()


def test_squared_distances_are_exact_where_doubles_are_not():
    rng = np.random.default_rng(2)
    for most in (1000, 1 << 27):
        x, c = rng.integers(-most, most, (50, 64)), rng.integers(-most, most, (8, 64))
        want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, w)) for w in c] for v in x]
        assert centroids.squared_distances(x, c).tolist() == want
