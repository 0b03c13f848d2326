"""The operators against brute force, exact round trips and held-out accuracy."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer, models

from entryclime.llm import bpe, chat, components, decontaminate, quality, sharding, simhash, token_counts
from entryclime.llm.oracle import ORACLE_SQL, SHARDING_SQL
from entryclime.llm.queries import QUERIES
from scripts.check_oracle import TABLES, digest, norm

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.sql("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, con, name):
    if name == "pipeline":
        pytest.skip("a query of the repository's top")
    got, want = norm(QUERIES[name](spark, SF).toPandas()), norm(con.sql(ORACLE_SQL[name]).df())
    assert list(got.columns) == list(want.columns) and digest(got) == digest(want)


# ---------------------------------------------------------------- 1 quality
def test_quality_held_out(spark, con):
    sf = "/root/testdata/sf0.01"
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall())
    rows = [r for r in QUERIES["op1_quality"](spark, sf).collect() if r["doc_id"] in labels]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_features_do_not_depend_on_pieces(monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abC D1.!|#é\n") for _ in range(n)) for n in (0, 1, 7, 500)]
    whole = quality.features_of(texts)
    alone = np.vstack([quality.features_of([t]) for t in texts])
    assert np.allclose(whole, alone)
    assert whole.shape == (4, len(quality.FEATURES)) and np.isfinite(whole).all() and not whole[0].any()


def test_class_prior_of_a_mixture(spark):
    """A third of the unlabelled rows are unlike the positives; the estimate finds the other two thirds."""
    rng = np.random.default_rng(0)
    k = len(quality.FEATURES)
    good, bad = rng.normal(0, 1, (4000, k)), rng.normal(0, 1, (2000, k)) + 3
    rows = [(x.astype(np.float32).tobytes(), i % 4 == 0) for i, x in enumerate(good)]
    rows += [(x.astype(np.float32).tobytes(), False) for x in bad]
    model = quality.fit(spark.createDataFrame(rows, "x binary, positive boolean"))
    assert abs(model.prior - 2 / 3) < 0.06
    assert (model.score(good) >= 0.5).mean() > 0.97 and (model.score(bad) < 0.5).mean() > 0.97


def _plain_sums(x, positive):
    """The sums that ``minimise`` asks for, of rows in memory."""
    def at(w):
        z, p = x @ w, positive
        s, loss = 1 / (1 + np.exp(-z)), np.logaddexp(0, z)  # the loss of a row taken for negative
        return {"unl_neg": loss.mean(), "pos_neg": loss[p].mean(), "pos_pos": (loss - z)[p].mean(),
                "unl_grad": x.T @ s / len(x), "pos_mean": x[p].mean(axis=0), "pos_grad": x[p].T @ s[p] / p.sum(),
                "unl_curve": (x * (s * (1 - s))[:, None]).T @ x / len(x)}
    return at


@pytest.mark.parametrize("prior", [0.3, 0.6, 0.9])
def test_risk_is_as_low_as_plain_descent(prior):
    """Against the plain non-negative method: thousands of small steps down, or up where the negative part is below 0.

    The right prior is 0.6. With 0.6 and 0.9 the negative part holds the steps back; to stop there left 0.12 and 0.55.
    """
    rng = np.random.default_rng(1)
    x = np.column_stack([np.ones(200), np.vstack([rng.normal(1, 1, (120, 3)), rng.normal(-1, 1, (80, 3))])])
    positive = np.arange(200) % 6 == 0
    positive[120:] = False
    at, ridge = _plain_sums(x, positive), 1e-3 * np.eye(4)

    def risk(w):
        s = at(w)
        negative = s["unl_neg"] - prior * s["pos_neg"]
        return prior * s["pos_pos"] + max(0, negative) + w @ ridge @ w / 2, negative

    w, least = np.zeros(4), risk(np.zeros(4))[0]
    for _ in range(3000):
        s = at(w)
        if s["unl_neg"] - prior * s["pos_neg"] >= 0:
            w = w - 0.3 * (s["unl_grad"] - prior * s["pos_mean"] + ridge @ w)
        else:
            w = w + 0.3 * (s["unl_grad"] - prior * s["pos_grad"])
        now, negative = risk(w)
        least = min(least, now) if negative >= 0 else least
    got, negative = risk(quality.minimise(at, prior, ridge))
    assert negative >= 0 and got <= least + 0.025


# ---------------------------------------------------------------- 2 token counts
def _greedy(word, initial, continuing):
    n = at = 0
    while at < len(word):
        best = max((len(p) for p in (continuing if at else initial) if word.startswith(p, at)), default=0)
        if not best:
            return 0
        n, at = n + 1, at + best
    return n


def test_automaton_on_all_short_words():
    words = ["".join(w) for n in range(1, 7) for w in itertools.product("ab", repeat=n)]
    rng = random.Random(2)
    for _ in range(60):
        initial, continuing = rng.sample(words[:30], rng.randint(1, 6)), rng.sample(words[:30], rng.randint(0, 6))
        automaton = token_counts.Automaton(initial, continuing)
        assert all(automaton.pieces(w) == _greedy(w, initial, continuing) for w in words)


def test_counts_match_the_library(spark, texts):
    path = public_tokenizers.path("piece_bpe_32k.model")
    initial, continuing = token_counts.sentencepiece_vocabulary(path)
    vocab = {p: i for i, p in enumerate(dict.fromkeys(["[UNK]", *filter(None, initial), *("##" + p for p in continuing)]))}
    library = models.WordPiece(vocab=vocab, unk_token="[UNK]", max_input_chars_per_word=10**9,
                               continuing_subword_prefix="##")
    for r in QUERIES["op2_token_counts"](spark, SF).collect():
        cut = [[t.value for t in library.tokenize(w)] for w in re.findall(r"\w+|[^\w\s]", texts[r["doc_id"]])]
        assert (r["n_words"], r["n_tokens"], r["n_unknown"]) == (len(cut), sum(map(len, cut)), cut.count(["[UNK]"]))


# ---------------------------------------------------------------- 4 decontamination
def _tokens(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def _leaks(docs, items):
    """Every diagonal of every document and item: the best window of 13 aligned tokens."""
    words = {i: _tokens(t) for i, t in items.items()}
    at = defaultdict(list)
    for i, w in words.items():
        for k, x in enumerate(w):
            at[x].append((i, k))
    found = set()
    for d, text in docs.items():
        aligned = defaultdict(list)
        for p, x in enumerate(_tokens(text)):
            for i, k in at.get(x, ()):
                aligned[i, p - k].append(k)
        for (i, _), ks in aligned.items():
            need = -(-8 * min(13, len(words[i])) // 10)
            if len(words[i]) >= 8 and len(ks) >= need and max(
                    sum(s <= k < s + 13 for k in ks) for s in range(-12, len(words[i]))) >= need:
                found.add((d, i))
    return found


def test_masks_hit_every_window_with_two_substitutions():
    for wrong in itertools.combinations(range(decontaminate.WINDOW), 2):
        assert any(not {at + o for o in mask} & set(wrong) for mask in decontaminate.MASKS
                   for at in range(decontaminate.WINDOW - mask[-1]))


def _allowed(n):
    return n - -(-8 * n // 10) if n >= 8 else 0


@pytest.mark.parametrize("n", range(1, 20))
def test_seeds_hit_every_placement(n):
    masks = [m for k, (m, *_) in enumerate(decontaminate._SEEDS) if decontaminate._serves(k, n)]
    for wrong in itertools.combinations(range(min(n, 13)), _allowed(min(n, 13))):
        assert any(not {at + o for o in mask} & set(wrong) for mask in masks for at in range(min(n, 13) - mask[-1])), wrong


def test_short_items_are_found(spark):
    """Items of 1 to 14 tokens with every placement of the allowed substitutions; with one more, or in part, none."""
    items, docs, want = {}, {}, set()
    for n in range(1, 15):
        words = [f"i{n}t{k}" for k in range(n)]
        items[n] = " ".join(words)
        k = _allowed(min(n, 13))
        for wrong in itertools.chain(itertools.combinations(range(n), k), itertools.combinations(range(n), k + 1)):
            d = len(docs)
            inner = " ".join("zzz" if x in wrong else w for x, w in enumerate(words))
            docs[d] = inner if d % 2 else f"some text before {inner} and after"
            gone = max(sum(s <= x < s + 13 for x in range(n) if x not in wrong) for s in range(max(1, n - 12)))
            if gone >= min(n, 13) - k:
                want.add((d, n))
    items[15], docs[10_000] = items[3], "ends with " + items[3].upper()
    want |= {(d, 15) for d, i in want if i == 3} | {(10_000, 3), (10_000, 15)}
    found = decontaminate.contaminated(spark.createDataFrame(list(docs.items()), "doc_id long, text string"),
                                       spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want
    assert {r["matched_tokens"] for r in found if r["item_id"] == 5} == {5}


def test_leaks_match_brute_force(spark, con, texts):
    items = dict(con.sql("SELECT item_id, text FROM benchmark").fetchall())
    rng = random.Random(3)
    docs = dict(texts)
    for n, (i, text) in enumerate(items.items()):  # planted: whole, every eighth word replaced, and a 13-word part
        words = text.split()
        docs[10_000 + n] = "before this " + text + " and after"
        docs[20_000 + n] = " ".join("zzz" if k % 8 == 4 else w for k, w in enumerate(words))
        docs[30_000 + n] = "x y " + " ".join(words[:13]) + " " + " ".join(rng.choice(words) for _ in range(40))
        docs[40_000 + n] = "nothing " + " ".join(rng.sample(words, len(words)))
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    found = decontaminate.contaminated(df, spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    assert got == _leaks(docs, items)
    for n, i in enumerate(items):
        assert (10_000 + n, i) in got and (20_000 + n, i) in got


# ---------------------------------------------------------------- 5 SimHash
def _fingerprint(text):
    w = text.encode().lower().split()
    shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _components(values, linked):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(values)), 2):
        if linked(values[i], values[j]):
            parent[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


def test_fingerprints(monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_BYTES", 16)
    rng = random.Random(5)
    texts = ["", " ", "A", "a b", "x\ty  z"] + [" ".join(rng.choice(["a", "A", "bé", "c d"]) for _ in range(n))
                                               for n in range(1, 60)]
    assert [int(x) for x in simhash.fingerprints_of(texts)] == [_fingerprint(t) for t in texts]


def test_the_code_is_perfect():
    words = np.arange(1 << 23, dtype=np.uint32)[::1009]
    rows, anchors, distance = simhash.anchors_of(words, 3)
    assert (np.bincount(rows, minlength=len(words)) == 1).all()
    assert not simhash._syndromes(anchors).any() and (np.bitwise_count(words[rows] ^ anchors) == distance).all()


@pytest.mark.parametrize("tile", [simhash.TILE, 7])
def test_links_match_brute_force(spark, tile):
    """Clusters around a few centres, so that anchors are crowded; a small tile refines and splits them."""
    rng = random.Random(6)
    fps = {0}
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(40):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = simhash.links(nodes, 2, tile)
    assert all(bin((r["u"] ^ r["v"]) & (1 << 64) - 1).count("1") > 0 for r in edges.collect())
    root = {r["node"]: r["root"] for r in components.components(edges).collect()}
    want = _components(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 2)
    groups = lambda labels: sorted(sorted(g) for g in labels.values())
    by_want, by_got = defaultdict(list), defaultdict(list)
    for f, w in zip(signed, want, strict=True):
        by_want[w].append(f)
        by_got[root.get(f, f)].append(f)
    assert groups(by_want) == groups(by_got)


def test_components_of_a_long_path(spark):
    order = random.Random(7).sample(range(400), 400)
    edges = spark.createDataFrame(list(zip(order, order[1:], strict=False)), "u long, v long")
    assert {r["root"] for r in components.components(edges).collect()} == {0}


def test_near_duplicates_match_brute_force(spark, texts):
    rows = {r["doc_id"]: r for r in QUERIES["op5_simhash"](spark, SF).collect()}
    ids = sorted(texts)
    fps = [_fingerprint(texts[i]) for i in ids]
    assert [rows[i]["fingerprint"] for i in ids] == [f"{f:016x}" for f in fps]
    label = _components(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for i, x in zip(ids, label, strict=True):
        least.setdefault(x, i)
    assert [rows[i]["component_id"] for i in ids] == [least[x] for x in label]


# ---------------------------------------------------------------- 7 chat
def test_rendered_turns_parse_back():
    pieces = ["<", "|", "\\", "<|", "<|im_end|>", "<|im_start|>", "\n", "assistant", "a", "<\\|", "<\\\\|im_end|>"]
    rng = random.Random(8)
    for _ in range(3000):
        role, text = ("".join(rng.choice(pieces) for _ in range(rng.randint(0, 6))) for _ in range(2))
        rendered, start, end = chat.render_turn(role, text)
        assert [(r, t) for r, t, _, _ in chat.parse(rendered * 2)] == [(role, text)] * 2
        assert chat.unescape(rendered[start:end]) == text


def test_plain_turns_are_not_changed():
    assert chat.render_turn("user", "a < b | c \\ d")[0] == "<|im_start|>user\na < b | c \\ d<|im_end|>\n"
    for wrong in ("x", "<|im_start|>user", "<|im_start|>user\na", "<|im_start|>a\nb<|im_start|><|im_end|>\n"):
        with pytest.raises(ValueError):
            chat.parse(wrong)


# ---------------------------------------------------------------- 8 sharding
def test_shards_match_sql(spark, con, texts):
    got = QUERIES["op8_sharding"](spark, SF).toPandas()
    assert [zlib.crc32((texts[i] or "").encode()) for i in got["doc_id"]] == got["text_crc32"].tolist()
    a, b = norm(got.drop(columns="text_crc32")), norm(con.sql(SHARDING_SQL).df())
    assert list(a.columns) == list(b.columns) and digest(a) == digest(b)


def test_a_tolerance_moves_boundaries_only_a_little(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sizes = Counter()
    for r in sharding.assign_shards(docs, 8, tolerance=5000).collect():
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) < 2 * (33_100 + 5000)


# ---------------------------------------------------------------- 9 BPE
def test_joins_are_exact():
    coder, library = bpe.tokenizer(BPE), Tokenizer.from_file(BPE)
    kinds = ["abcdefgh'strevmld   ", "aaaaaabbbb", "中文字符测试没有空格", "0123456789", " \n\t   　", "!?.,'<|>endoftext",
             "éèüßñ ab12!'", "😀🎉👍🏽é", "abc DEF 123 !'s\n"]
    rng = random.Random(9)
    for _ in range(800):
        text = ""
        while len(text) < 300:
            text += "".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randint(1, 4)))
            kind = rng.choice(kinds)
            text += "".join(rng.choice(kind) for _ in range(rng.choice([3, 40, 200])))
            text += rng.choice(["", "", "<|endoftext|>", "'re", "international"])
        text = text[:rng.randint(1, 600)]
        leaves = [coder.encode(part) for part in bpe.halves(text, rng.choice([3, 8, 17, 40, 100]))]
        got = coder.join_all(leaves)
        assert got.tolist() == library.encode(text, add_special_tokens=False).ids
        assert coder.decode(got) == text


def test_every_character_has_the_kind_of_the_library():
    coder = bpe.tokenizer(BPE)
    assert [coder.kind(c) for c in "aé中1٣!😀 \n　_'"] == list("LLLNNOOSSSOO")


def test_long_texts_through_spark(spark, texts):
    library = Tokenizer.from_file(BPE)
    rows = {**texts, -1: "中文" * 5000, -2: "ab " * 9000, -3: None, -4: "a" * 7000}
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in bpe.encode_decode(df, BPE, leaf_chars=200).collect()}
    assert len(got) == len(rows)
    for i, text in rows.items():
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[i]["ids"] == np.array(ids, "<u4").tobytes() and got[i]["n_tokens"] == len(ids)
        assert got[i]["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_digests_of_the_query(spark, texts):
    library = Tokenizer.from_file(BPE)
    for r in QUERIES["op9_bpe"](spark, SF).collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


# ---------------------------------------------------------------- 10 language
def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    lang = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{sf}/documents.parquet'").fetchall())
    rows = QUERIES["op10_langid"](spark, sf).collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert sum(r["rejected"] for r in rows) <= 0.002 * len(rows)


def _grams(text):
    """Letter bigrams and trigrams with word ends, one by one, by their bucket."""
    from entryclime.llm import langid

    signs, mask = [0], (1 << 64) - 1
    for c in text.lower():
        code = ord(c) if c.isalpha() else 0
        if code or signs[-1]:
            signs.append(code)
    signs.append(0)
    found = Counter()
    for a, b, c in zip(signs, signs[1:], signs[2:], strict=False):
        if b:
            two = (b * 0x9E3779B97F4A7C15 + c * 0xC2B2AE3D27D4EB4F) * 0xD6E8FEB86659FD93 & mask
            three = (two + a * 0xA0761D6478BD642F) * 0xE7037ED1A0B428DB & mask
            for h in (two, three):
                found[h * langid.DIM >> 64] += 1
    return found


@pytest.mark.parametrize("piece", [1, 7, 100, 1 << 16])
def test_gram_counts_match_plain_ones_wherever_texts_are_cut(monkeypatch, piece):
    from entryclime.llm import langid

    monkeypatch.setattr(langid, "_PIECE", piece)
    rng = random.Random(12)
    texts = ["", "a", "  1 ", "İstanbul ΑΣ. Σ", "x\n\ny"] + ["".join(rng.choices("abcΣÉ 1.\nß中", k=n)) for n in (5, 60, 400)]
    counts, letters = langid._counts(texts)
    for i, text in enumerate(texts):
        want = _grams(text)
        assert {b: n for b, n in enumerate(counts[i].tolist()) if n} == want
        assert letters[i] == sum(c.isalpha() for c in text.lower())


def test_predictions_match_plain_cosines(spark):
    """Frequencies, weights and the nearest centroid of every document, from dictionaries and single products."""
    from entryclime.llm import langid

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    model = langid.fit(docs)
    learned = [_grams(r["text"]) for r in docs.where("text IS NOT NULL AND lang IS NOT NULL").collect()]
    seen = Counter(b for g in learned for b in g)
    idf = [np.log((1 + len(learned)) / (1 + seen[b])) + 1 for b in range(langid.DIM)]
    assert np.allclose(model.idf, idf, rtol=1e-5)
    got = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    for d, text in rows:
        v = {b: np.log1p(n) * idf[b] for b, n in _grams(text).items()}
        norm_v = sum(x * x for x in v.values()) ** 0.5 or 1
        cosines = [sum(x * float(c[b]) for b, x in v.items()) / norm_v for c in model.centroids]
        assert abs(got[d]["score"] - max(cosines)) < 1e-4
        assert max(c for c, x in zip(cosines, model.langs, strict=True) if x == got[d]["lang_pred"]) > max(cosines) - 1e-4


def test_gibberish_is_rejected(spark):
    from entryclime.llm import langid

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rng = random.Random(10)
    odd = [(100_000 + i, "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(400)), None, None, None)
           for i in range(5)]
    found = langid.identify_by_folds(docs.unionByName(spark.createDataFrame(odd, docs.schema)))
    assert {r["rejected"] for r in found.where("doc_id >= 100000").collect()} == {True}


def test_every_length_has_a_floor(spark):
    """Gibberish longer than any training text is rejected, and labelled gibberish alone in its length is no measure."""
    from entryclime.llm import langid

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    rng = random.Random(11)
    odd = [(100_000 + n, " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(n // 6)), lang,
            None, None) for n, lang in ((300, None), (1800, None), (18_000, None), (180_000, None), (720_000, "en"))]
    both = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    found = langid.identify(both, model, "lang IS NOT NULL").collect()
    assert {r["doc_id"] for r in found if r["rejected"] and r["doc_id"] >= 100_000} == {r[0] for r in odd}
    assert sum(r["rejected"] for r in found if r["doc_id"] < 100_000) <= 0.002 * len(found)


def test_windows_of_length_classes():
    from entryclime.llm import langid

    windows = langid._windows({6: 3, 8: 10, 9: 12, 11: 4, 14: 1}, 10)
    assert set(windows) == set(range(6, 32))
    assert [windows[c] for c in (6, 8, 9, 10, 14, 20)] == [(6, 8), (8, 8), (9, 9), (9, 11), (9, 19), (9, 31)]
    assert langid._windows({}, 10)[7] == (7, 7) and langid._windows({8: 3}, 10)[7] == (6, 8)
