"""Scores by held-out accuracy and exact recounts; the pipeline stage by stage."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from barlake.llm import best_fit, bloom_lm, site_quality, toxicity
from barlake.llm.common import packed, unpacked
from barlake.llm.queries import tokenizer_file

TEXTS = "doc_id long, text string, score string, held_out string"
LABELS = "doc_id long, quality int, toxic int"


def frame(spark, data, schema=TEXTS):
    return spark.createDataFrame(data, schema).repartition(3)


def fold(i, n):
    return zlib.crc32(("null" if i is None else str(i)).encode()) % n


# ---- toxicity --------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_accepts_what_one_edit_reaches():
    rng = random.Random(3)
    terms = ["idiot$", "moron$", "scum$", "lowei", "stupid$"]
    lexicon = toxicity.Lexicon(terms, {"motion"})
    words = [t.rstrip("$") for t in terms] + ["motion", "loweix", "lowe", "xlowei", "scums", "", "zzzz"]
    for _ in range(3000):
        w = list(rng.choice(words))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(w) + 1)
            w[at : at + rng.randrange(2)] = rng.choice(["", *"idotmrnscuple"])
        words.append("".join(w))
    for word in words:
        exact = word.startswith("lowei") or word + "$" in terms
        near = any(distance(word, t[:-1]) <= toxicity.edits_allowed(t) for t in terms if t.endswith("$"))
        hit = lexicon.match(word)
        assert (hit is not None) == (exact or (near and word != "motion")), word
        assert hit is None or (hit[1] == 0) == exact
    assert len(lexicon.states) < 2000


def test_stems_and_swapped_letters_are_met_within_an_edit():
    lexicon = toxicity.Lexicon(["idiot", "moron$", "xyz$", "vekk"], {"idio*", "idiom*"}, edited_stems=True)
    for word in ("idoit", "idi0t", "idi0ts", "iditos", "idoitisch", "xidiot", "iidiot", "idio7s", "diiot"):
        assert lexicon.match(word) == ("idiot", 1), word
    assert lexicon.match("idiots") == ("idiot", 0)
    assert [lexicon.match(w) for w in ("mroon", "morno", "omron")] == [("moron$", 1)] * 3
    assert lexicon.match("xyz") == ("xyz$", 0)
    for word in ("idiom", "idiomatisch", "idio", "mroons", "xzy", "xy", "vkek", "vek", "", "io"):
        assert lexicon.match(word) is None, word
    assert set(lexicon.near("idiomatisch")) == {"idio*", "idiom*"} and lexicon.near("idiots") == []


def test_misspelled_stems_and_short_words_count(spark):
    rng = random.Random(8)
    calm = [f"{a}{b}" for a in ("ber", "tal", "mon", "ris") for b in ("el", "and", "ig", "ura", "os")]
    bad = [["idiot", "idiots"], ["kxq"]]
    rows, labels = [], []
    for n in range(900):
        words = [rng.choice(calm) for _ in range(rng.randrange(8, 40))]
        if n % 6 == 0:
            words.insert(rng.randrange(len(words)), rng.choice(bad[n // 6 % 2]))
        rows.append((n, " ".join(words), "0", "x"))
        labels.append((n, 1, int(n % 6 == 0)))
    said = ["idi0t", "idoits", "kxq", "talel"]
    rows += [(5000 + n, f"tal {w} berel monig", "0", "x") for n, w in enumerate(said)]
    out = {r.doc_id: r for r in toxicity.score(frame(spark, rows), frame(spark, labels, LABELS)).collect()}
    assert all(out[5000 + n].score > 3 * out[5003].score for n in range(3))
    assert out[5002].predicted == 1 and out[5003].predicted == 0


def test_quotation_weighs_less():
    lexicon = toxicity.Lexicon(["idiot$"])
    weight = lambda text: [w for _, _, w in toxicity.hits(text, lexicon, {})]
    assert weight("you are an idiot today") == [1.0]
    assert weight('he wrote "what an idiot" to them') == [toxicity.QUOTED]
    assert weight("«idiot», a word") == [toxicity.QUOTED]
    assert weight("an " + "calm " * 5000 + "idiiot") == [1.0]


def toxic_rows():
    rng = random.Random(6)
    calm = [f"{a}{b}" for a in ("ber", "tal", "mon", "ris", "ven", "ost") for b in ("el", "and", "ig", "ura", "os", "ent")]
    rows, labels = [], []
    for n in range(900):
        words = [rng.choice(calm) for _ in range(rng.randrange(5, 60))]
        bad = n % 6 == 0
        for _ in range(rng.randrange(1, 4) if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["grumpf", "snorble", "Snorble!", "vekku" + rng.choice(calm)]))
        rows.append((n, " ".join(words), "0", "x"))
        labels.append((n, 1, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_rows()
    extra = [(5000, None, "a", None), (5001, "", "a", None), (5002, "tal snorbel mon", None, None), (None, "tal", None, None), (5003, "x " * 30000, None, None)]
    known = frame(spark, labels + [(1, 1, None), (None, 1, 1), (99999, 0, 1)], LABELS)
    out = {r.doc_id: r for r in toxicity.score(frame(spark, rows + extra), known).collect()}
    assert len(out) == len(rows) + len(extra)
    for i, _, toxic in labels:
        assert out[i].held_out == (fold(i, 3) == 1)
        assert 0 <= out[i].score <= 1 and out[i].predicted == int(out[i].score >= 0.7)
    held = [(out[i].predicted, toxic) for i, _, toxic in labels if out[i].held_out]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    assert out[5000].score == out[5001].score < 0.5
    # Labels of held-out rows change nothing.
    flipped = [(i, q, 1 - t if fold(i, 3) == 1 else t) for i, q, t in labels]
    again = toxicity.score(frame(spark, rows), frame(spark, flipped, LABELS)).collect()
    assert all(r.score == pytest.approx(out[r.doc_id].score) for r in again)


def test_every_term_that_stands_out_is_learned():
    counts = {f"term{n:04d}$": (6 + n % 40, 0) for n in range(3000)}
    assert toxicity.choose_terms(counts | {"calm$": (5, 900)}, 2000, 20_000, 10_000) == sorted(counts)
    # A stem still covers its longer forms.
    assert toxicity.choose_terms({"vekk": (9, 0), "vekka$": (4, 0), "vekko$": (4, 0)}, 20, 200, 10) == ["vekk"]


def test_toxicity_without_labels_or_rows(spark):
    docs = frame(spark, [(1, "a", None, None)])
    assert [r.predicted for r in toxicity.score(docs, frame(spark, [], LABELS)).collect()] == [0]
    assert toxicity.score(frame(spark, []), frame(spark, [(1, 1, 1)], LABELS)).count() == 0


# ---- language model --------------------------------------------------------------


def lm_rows():
    rng = random.Random(9)
    vocabulary = [f"w{n}" for n in range(80)] + ["Ünï", "x y", "BIG", "big"]
    weights = [1 / (n + 1) for n in range(len(vocabulary))]
    rows = [(n, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(1, 50))), "s", "t") for n in range(400)]
    rows += [(1000, None, None, None), (1001, "", None, None), (1002, "\x1cfs \t x", None, None), (1003, "only-here " * 3, None, None)]
    return rows + [rows[5], (None, "w1 w2", None, None)]


def tokens(text):
    return [*re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")), ""]


@pytest.mark.parametrize("head", [0, 5, 100_000])
def test_base_score_is_exact_and_model_beats_it(spark, head):
    rows = lm_rows()
    out = defaultdict(list)
    for r in bloom_lm.score(frame(spark, rows), head=head).collect():
        out[r.doc_id].append(r)
    counts = Counter(w for i, t, *_ in rows if fold(i, 7) != 2 for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    base, model = 0.0, 0.0
    for i, text, *_ in rows:
        own = tokens(text)
        want = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        for r in out[i]:
            assert (r.held_out, r.n_tokens, r.train_tokens) == (fold(i, 7) == 2, len(own), n)
            assert r.n_known == sum(counts[w] > 0 for w in own)
            assert r.base_score == pytest.approx(want, rel=1e-9)
            assert r.score < 0
            base, model = base + r.base_score, model + r.score
    assert len(out[5]) == 2 and model > base


@pytest.mark.parametrize("head", [0, 100_000])
def test_filter_over_the_broadcast_bound_scores_alike(spark, monkeypatch, head):
    monkeypatch.setattr(bloom_lm, "CHUNK", 300)
    rng = random.Random(12)
    rows = lm_rows() + [(2000 + n, " ".join(f"z{rng.randrange(3000)}" for _ in range(300)), "s", "t") for n in range(60)]
    key = lambda r: (r.doc_id is None, r.doc_id, r.n_tokens, r.score)
    whole = sorted(bloom_lm.score(frame(spark, rows), head=head).collect(), key=key)
    parts = sorted(bloom_lm.score(frame(spark, rows), head=head, max_bytes=1024).collect(), key=key)
    assert len(parts) == len(whole) == len(rows)
    for a, b in zip(whole, parts):
        assert (a.doc_id, a.held_out, a.n_tokens, a.n_known) == (b.doc_id, b.held_out, b.n_tokens, b.n_known)
        assert b.score == pytest.approx(a.score) and b.base_score == pytest.approx(a.base_score)


def test_filter_probed_by_range_sends_a_key_once(spark, monkeypatch):
    """A merged range knows what the chunks ask for: answers need no exchange, keys are sent once, for counting."""
    monkeypatch.setattr(bloom_lm, "CHUNK", 300)
    made, plain = {}, bloom_lm.stage

    def noted(df, label):
        made[label] = df._jdf.queryExecution().toString().count("Exchange ")
        return plain(df, label)

    monkeypatch.setattr(bloom_lm, "stage", noted)
    rows = lm_rows()
    assert bloom_lm.score(frame(spark, rows), max_bytes=1).count() == len(rows)
    assert made["lm-answers"] == 0


def test_distinct_keys_of_a_chunk_take_a_sort_and_no_hash_table(monkeypatch):
    """numpy's unique without counts or places may build a hash table, many times slower than a sort."""
    rng = random.Random(21)
    words = [b""] + [b"w%d" % n for n in range(400)]
    ids = [[*(rng.randrange(1, 401) for _ in range(rng.randrange(60))), 0] for _ in range(50)]
    held = [n % 7 == 2 for n in range(50)]
    flat = np.array(sum(ids, []), np.int32)
    lengths = np.array([len(x) for x in ids], np.int64)
    row = {"chunk": 5, "words": b" ".join(words), "flat": packed(flat), "lengths": lengths.tobytes(), "held": held}
    plain = np.unique

    def noted(values, **asked):
        assert asked, "unique without counts or places"
        return plain(values, **asked)

    monkeypatch.setattr(np, "unique", noted)
    for shards in (1, 16):
        own, of_pair = bloom_lm._chunk_keys(words, flat, shards)
        train = np.repeat(~np.array(held), lengths)
        times = Counter(of_pair[train].tolist())
        every = sorted({*own.tolist(), *of_pair.tolist()})
        sent = list(bloom_lm._send_chunk(row, shards))
        keys = np.concatenate([bloom_lm.unpack_keys(s[4], s[0], shards) for s in sent])
        assert keys.tolist() == every
        assert np.concatenate([unpacked(s[5], np.int64) for s in sent]).tolist() == [times[k] for k in every]
        own_at, pair_at = bloom_lm._places(own, of_pair)
        assert (keys[own_at] == own).all() and (keys[pair_at] == of_pair).all()
    assert bloom_lm.distinct(np.zeros(0, np.uint64)).tolist() == []
    assert bloom_lm.distinct(np.array([3, 1, 3], np.uint64)).tolist() == [1, 3]


def test_score_against_an_exact_recount(spark):
    """The model with exact levels in place of probes: a false probe can only raise a count."""
    rows = [r for r in lm_rows() if r[0] is not None]
    words, pairs = Counter(), Counter()
    for i, text, *_ in rows:
        if fold(i, 7) != 2:
            own = [*tokens(text)]
            words.update(own)
            pairs.update(zip([own[-1], *own[:-1]], own))
    n, v = sum(words.values()), len(words)
    near = lambda c: float(bloom_lm.EXPECTED[bloom_lm.levels(np.array([c]))[0]]) if c else 0.0
    got = defaultdict(list)
    for r in bloom_lm.score(frame(spark, rows)).collect():
        got[r.doc_id].append(r)
    off, size = 0.0, 0
    for i, text, *_ in rows:
        own, want = [*tokens(text)], 0.0
        for before, word in zip([own[-1], *own[:-1]], own):
            single = (near(words[word]) + 1) / (n + v + 1)
            context = near(words[before])
            want += math.log10((min(near(pairs[before, word]), context) + bloom_lm.PRIOR * single) / (context + bloom_lm.PRIOR))
        off += min(abs(r.score - want) for r in got[i])
        size += len(own)
    assert off / size < 0.02


def test_narrow_keys_come_back():
    rng = np.random.default_rng(3)
    for shards in (1, 16, 1 << 20, 1 << 26):
        keys = np.unique(bloom_lm.narrow(rng.integers(0, 1 << 64, 3000, dtype=np.uint64), shards))
        top = shards.bit_length() - 1
        for shard in ({0} if not top else {int(k) >> (64 - top) for k in keys[:50]}):
            own = keys if not top else keys[(keys >> np.uint64(64 - top)) == shard]
            assert (bloom_lm.unpack_keys(bloom_lm.pack_keys(own, shards), shard, shards) == own).all()


def test_filter_finds_every_entry_and_seldom_others():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2))
    counts = rng.integers(1, 5000, len(keys))
    level = bloom_lm.levels(counts)
    shards, part_bits = 4, 1 << 18
    part = (keys >> np.uint64(62)).astype(int)
    bits = b"".join(bloom_lm.filter_part(keys[part == p], level[part == p], part_bits) for p in range(shards))
    held = bloom_lm.Filter(np.frombuffer(bits, np.uint8), shards)
    found = held.level(keys)
    assert (found >= level).all() and (found == level).mean() > 0.95
    other = held.level(rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    assert (other > 0).mean() < 0.05
    assert list(bloom_lm.levels(np.array([1, 2, 3, 4]))) == [1, 2, 3, 4]


def test_model_without_texts(spark):
    assert bloom_lm.score(frame(spark, [])).count() == 0
    held = next(i for i in range(100) if fold(i, 7) == 2)
    r = bloom_lm.score(frame(spark, [(held, "a b", None, None)])).first()
    assert (r.train_tokens, r.n_known, r.base_score, r.score) == (0, 0, 0.0, 0.0)


# ---- quality ---------------------------------------------------------------------

SITES = "doc_id long, text string, source string, lang string, quality double, host string"


def site_rows():
    rng = random.Random(12)
    rows, labels = [], []
    for n in range(700):
        junk = n % 5 == 0
        words = ["".join(rng.choice("aeioubdgklmnrst") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(8, 80))]
        text = " ".join(w + "###" if junk else w for w in words)
        rows.append((n, text, f"s{n % 4}" if n % 9 else None, "en" if n % 2 else None, None, "h"))
        labels.append((n, int(not junk), 0))
    return rows, labels


def test_quality_on_held_out_rows(spark):
    rows, labels = site_rows()
    extra = [(9000, None, "s1", "en", 1.0, None), (9001, "", "new", "xx", 1.0, None), (None, "lorem ipsum", None, None, None, None)]
    out = {r.doc_id: r for r in site_quality.score(frame(spark, rows + extra, SITES), frame(spark, labels, LABELS)).collect()}
    assert len(out) == len(rows) + len(extra)
    held = [(out[i].keep, bool(q)) for i, q, _ in labels if fold(i, 3) == 1]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    assert all(0 < r.site_score < 1 for r in out.values())
    kept = site_quality.keep_good(frame(spark, rows + extra, SITES), frame(spark, labels, LABELS))
    assert kept.columns == ["doc_id", "text", "source", "lang", "quality", "host"]
    assert {r.doc_id for r in kept.collect()} == {i for i, r in out.items() if r.keep or i is None}
    assert site_quality.score(frame(spark, [], SITES), frame(spark, labels, LABELS)).count() == 0


def test_texts_reach_the_model_in_small_batches(spark, tmp_path, monkeypatch):
    """A whole split in one Arrow batch is held several times outside the heap of an executor."""
    plain, seen = site_quality._probabilities, str(tmp_path)

    def noted(batches, beta):
        for batch in batches:
            with open(f"{seen}/sizes", "a") as file:
                file.write(f"{batch.num_rows}\n")
            yield from plain(iter([batch]), beta)

    monkeypatch.setattr(site_quality, "_probabilities", noted)
    rows, labels = site_rows()
    rows = [(n + 700 * k, *row) for k in range(4) for n, *row in rows]
    docs = spark.createDataFrame(rows, SITES).coalesce(1)
    labels = spark.createDataFrame([(n + 700 * k, *row) for k in range(4) for n, *row in labels], LABELS).coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert site_quality.keep_good(docs, labels).count() > 0
    sizes = [int(n) for n in (tmp_path / "sizes").read_text().split()]
    assert max(sizes) <= 1_000 and sum(sizes) == len(rows) + sum(fold(n, 3) != 1 for n in range(len(rows)))
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def brute_strength(groups):
    """(mean, n, good) of each group: how many documents the prior is worth."""
    several = [(m, n, g / n) for m, n, g in groups if n >= 2]
    spread = sum(n * (p - m) ** 2 for m, n, p in several)
    chance = sum(m * (1 - m) for m, _, _ in several)
    weight = sum(n * m * (1 - m) for m, n, _ in several)
    beyond = (spread - chance) / weight if weight else 0
    most = site_quality.MOST_STRENGTH
    return min(most, max(1.0, 1 / beyond)) if beyond > 0 else most


def test_site_posteriors_equal_a_recount(spark):
    rows, labels = site_rows()
    rows += [(9000, None, "s1", "en", 1.0, None), (9001, "", "new", "xx", 1.0, None)]
    out = site_quality.score(frame(spark, rows, SITES), frame(spark, labels, LABELS)).collect()
    paths, hosts = {}, {}
    for r in out:
        for counts, key in ((paths, (r.host, r.path)), (hosts, r.host)):
            n, good = counts.get(key, (0, 0.0))
            counts[key] = (n + 1, good + r.text_score)
    mean = sum(r.text_score for r in out) / len(out)
    prior = brute_strength([(mean, n, g) for n, g in hosts.values()])
    host_mean = {h: (g + prior * mean) / (n + prior) for h, (n, g) in hosts.items()}
    below = brute_strength([(host_mean[h], n, g) for (h, _), (n, g) in paths.items()])
    logit = lambda p: math.log(p / (1 - p))
    for r in out:
        n, good = paths[r.host, r.path]
        site = (good + below * host_mean[r.host]) / (n + below)
        assert r.site_score == pytest.approx(site, abs=1e-9)
        own = min(max(r.text_score, 1e-6), 1 - 1e-6)
        if own == r.text_score:
            assert logit(min(max(r.quality, 1e-12), 1 - 1e-12)) == pytest.approx(logit(own) + logit(site) - logit(mean), abs=1e-4)
        assert r.keep == (r.quality >= site_quality.THRESHOLD)


def test_sparse_sites_shrink_toward_their_host(spark):
    groups = spark.createDataFrame([("a", 1000.0, 900.0, 0.5), ("b", 1000.0, 100.0, 0.5)], "g string, n double, good double, m double")
    assert site_quality.strength(groups, "m", "n", "good") < 10
    same = spark.createDataFrame([("a", 1000.0, 500.0, 0.5), ("b", 10.0, 5.0, 0.5)], "g string, n double, good double, m double")
    assert site_quality.strength(same, "m", "n", "good") == site_quality.MOST_STRENGTH


# ---- pipeline --------------------------------------------------------------------


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(1)
    rows, labels = site_rows()
    docs = [(i, text, source or "none", lang or "xx", len(text)) for i, text, source, lang, *_ in rows]
    docs += [(2000 + n, docs[n][1], "copy", "en", 1) for n in range(1, 60)]
    for n in range(61, 120):
        words = docs[n][1].split()
        if len(words) > 45 and n % 5:
            words[rng.randrange(len(words))] = "changed"
            docs.append((3000 + n, " ".join(words), "near", "en", 1))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, t, l, s, c) for i, t, s, l, c in docs], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    current = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for n, (name, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, current, str(tmp_path)).write.parquet(f"{tmp_path}/{n}")
        current = spark.read.parquet(f"{tmp_path}/{n}")
        if n < 4:
            assert current.columns == list(corpus_pipeline.COLUMNS), name
            kept.append([r.doc_id for r in current.collect()])
    good, distinct, one_each, mixed = kept
    junk = {i for i, q, _ in labels if not q}
    assert len(set(good) & junk) <= 0.03 * len(junk) and len(set(good) | junk) >= 0.97 * len(docs)
    texts = {i: " ".join(t.split()) for i, t, *_ in docs}
    first = {}
    for i in sorted(good):
        first.setdefault(texts[i], i)
    assert sorted(distinct) == sorted(first.values())
    assert not [i for i in one_each if i >= 3000 and i - 3000 in one_each]
    assert set(distinct) - set(one_each) == {i for i in distinct if i >= 3000 and i - 3000 in distinct}
    assert set(mixed) <= set(one_each) and max(Counter(mixed).values()) <= 2
    pieces = Counter(r.doc_id for r in current.collect() if r.piece == 0)
    assert pieces == Counter(mixed)
    ran = corpus_pipeline.run(spark, str(tmp_path))
    assert ran.count() == current.count() and tokenizer_file() and best_fit.WIDTH == 1024


def test_pipeline_on_nulls_repeats_and_no_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    words = " ".join(f"wort{n}" for n in range(60))
    rows = [(1, words, "en", "a", 1), (1, words, "en", "a", 1), (1, words.replace("wort7", "x"), None, None, None)]
    rows += [(2, None, None, None, None), (3, "", "en", "a", 0), (None, "eins zwei drei", None, "b", 14)]
    rows += [(4, "lang " * 200_000, "de", "b", 1_000_000)]
    for name, data in (("some", rows), ("none", [])):
        root = tmp_path / name
        spark.createDataFrame(data, schema).write.parquet(f"{root}/documents.parquet")
        spark.createDataFrame([(1, 1, 0)] if data else [], LABELS).write.parquet(f"{root}/labels.parquet")
        out = corpus_pipeline.run(spark, str(root)).collect()
        if not data:
            assert out == []
        else:
            assert {r.doc_id for r in out} <= {1, 2, 3, 4, None} and {1, 4} <= {r.doc_id for r in out}
            filled = Counter()
            for r in out:
                filled[r.sequence_id] += r.length
            assert max(filled.values()) <= best_fit.WIDTH
