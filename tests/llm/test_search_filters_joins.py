"""Search, url rules, repeats and near duplicates against brute force."""

import hashlib
import itertools
import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from barlake.llm import jaccard_join, oracles, pivot_topk, repeat_index, url_filter
from barlake.llm.common import WordHashes, packed, unpacked
from barlake.llm.components import connected_components

TEXTS = "doc_id long, text string, source string, counts string"


def frame(spark, data, schema=TEXTS):
    return spark.createDataFrame(data, schema).repartition(3)


class Roots(dict):
    """Union-find whose roots are the smallest members."""

    def of(self, i):
        while self.setdefault(i, i) != i:
            i = self[i]
        return i

    def join(self, a, b):
        a, b = sorted((self.of(a), self.of(b)))
        self[b] = a


# ---- components ------------------------------------------------------------------


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, n) for n in range(200, 320)]
    edges += [(n, (n + 1) % 9 + 400) for n in range(400, 409)] + [(1, 1), (2, 3), (3, 2)]
    edges += [(rng.randrange(500, 600), rng.randrange(500, 600)) for _ in range(60)]
    roots = Roots()
    for a, b in edges:
        roots.join(a, b)
    out = connected_components(frame(spark, edges, "a long, b long")).collect()
    groups, want = defaultdict(set), defaultdict(set)
    for r in out:
        groups[r.root].add(r.node)
    for i in {x for e in edges if e[0] != e[1] for x in e}:
        want[roots.of(i)].add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
    assert all(root in members for root, members in groups.items())
    assert connected_components(frame(spark, [], "a string, b string")).count() == 0


# ---- top k -----------------------------------------------------------------------


def brute_top(rows, k, step):
    usable = [
        (n, i, [int(np.floor(64.0 * x)) for x in v])
        for n, (i, v, *_) in enumerate(rows)
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for n, i, q in usable:
        if i % step == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for m, j, v in usable if m != n)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def test_top_k_is_exact(spark, monkeypatch):
    rng = random.Random(2)
    hot = [rng.gauss(0, 0.3) for _ in range(6)]
    rows = [(i, list(hot) if i % 3 == 0 else [rng.gauss(0, 0.3) for _ in range(6)], 1) for i in range(400)]
    rows += [(1000, None, 1), (1001, [None] * 6, 1), (1020, [float("nan")] * 6, 1), (None, [0.1] * 6, 1)]
    rows += [(1040, [0.5, 0.5], 1), (20, list(hot), 1), (1060, [], 1), (1061, [0.0] * 6, 1)]
    df = frame(spark, rows, "vec_id long, embedding array<double>, score int")
    monkeypatch.setattr(pivot_topk, "LEAST_CHUNK", 16)
    monkeypatch.setattr(pivot_topk, "ANNULUS", 8)
    monkeypatch.setattr(pivot_topk, "QUERY_BLOCK", 10)
    for k in (1, 20, 1000):
        got = sorted(map(tuple, pivot_topk.top_k(df, k=k).collect()))
        assert got == brute_top(rows, k, 20)
    monkeypatch.setattr(pivot_topk, "MOST_CHUNK", 10)
    assert sorted(map(tuple, pivot_topk.top_k(df, k=20).collect())) == brute_top(rows, 20, 20)
    assert pivot_topk.top_k(frame(spark, [], "vec_id long, embedding array<float>")).count() == 0


# ---- urls ------------------------------------------------------------------------


def page(links="", refresh=""):
    head = f'<link href="{links}" rel="canonical">' if links else ""
    head += f'<META http-equiv=refresh content="0; URL={refresh}">' if refresh else ""
    return f"<html><head>{head}</head><body>canonical</body></html>"


def test_rules_and_aliases(spark):
    rows = [
        (1, "https://Example.COM/en/a", page(), "com/", None),
        (2, "http://www.example.com/en/a?x#y", None, "www", None),
        (3, "http://a.net/fr/x", page("https://b.org/one"), "r", None),
        (4, "https://b.org/one#part", page(), "", None),
        (5, "https://b.org/two", page(refresh="/one"), "", None),
        (6, "https://b.org/dir/three?q=1", page("four"), "", None),
        (7, "https://b.org/dir/four", page(refresh="//B.ORG/two"), "", None),
        (8, "https://c.com/x", page("https://b.org/one"), "", None),
        (9, "https://d.org", page("https://e.net/es/z"), "", None),
        (10, "https://d.org/", page(), "", None),
        (11, None, page("https://b.org/one"), "", None),
        (12, "b.org/one", page(), "", None),
        (13, "https://example.com", None, "", None),
        (14, "https://notexample.com/en/", None, "", None),
        (15, "https://q.org/free", page("https://q.org/other"), "", None),
        (15, "https://q.org/free", page("https://q.org/other"), "", None),
    ]
    table = frame(spark, rows, "page_id long, url string, html string, rule string, _url string")
    out = url_filter.judge(table).collect()
    pages = duckdb.connect()
    pages.register("pages", table.select("page_id", "url", "html").toArrow())
    assert sorted(pages.execute(oracles.URL_FILTER).fetchall(), key=str) == sorted(map(tuple, out), key=str)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out}
    assert len(out) == len(rows)
    assert got[1] == ("example.com", "/en/a", "example.com/en/", "block")
    assert got[2] == ("www.example.com", "/en/a", "www.example.com/en/", "allow")
    assert got[3] == ("a.net", "/fr/x", "net/fr/", "block")
    for n in (4, 5, 6, 7, 9, 10):
        assert got[n][2:] == (None, "block"), n
    assert got[8] == ("c.com", "/x", "com/", "allow")
    assert got[11] == ("", "", None, "allow") and got[12] == ("", "", None, "allow")
    assert got[13] == ("example.com", "", None, "allow")
    assert got[14] == ("notexample.com", "/en/", "com/", "allow")
    assert got[15] == ("q.org", "/free", None, "allow")
    assert url_filter.judge(frame(spark, [], "page_id long, url string, html string")).count() == 0


def test_links_are_found_among_other_tags_and_resolved(spark):
    tags = '<link rel="alternate canonical" href="../other/./b?x=1"><link rel=canonical href=\'?page=2\'>'
    tags += '<link rel="canonicals" href="/wrong"><link rel="shortcut-canonical" href="/wrong2">'
    more = "<meta http-equiv='refresh' content='5;url=/far/../../up/..'>"
    rows = [(1, "https://a.org/en/dir/p?q#f", "x" * 3_000_000 + tags + more), (2, "https://a.org/en/other/b?x=1", None)]
    edges = url_filter.alias_edges(frame(spark, rows, "page_id long, url string, html string"))
    ends = {"https://a.org/en/other/b?x=1", "https://a.org/en/dir/p?page=2", "https://a.org/"}
    assert {(r.a, r.b) for r in edges.collect()} == {("https://a.org/en/dir/p?q", end) for end in ends}
    links = ["/a/b/../c", "/./a/", "/..", "/a/..", "/a/.", "/a..b/.c", "", "/a/../..//x?q=/../y#/./z"]
    want = ["/a/c", "/a/", "/", "/", "/a/", "/a..b/.c", "", "//x?q=/../y#/./z"]
    table = frame(spark, [(n, f"http://h{link}") for n, link in enumerate(links)], "n int, u string")
    got = {r.n: r.d for r in table.select("n", url_filter.without_dots(F.col("u")).alias("d")).collect()}
    assert got == {n: f"http://h{path}" for n, path in enumerate(want)}


# ---- repeats ---------------------------------------------------------------------


def brute_repeats(docs, size=50):
    first = {}
    for i, text in docs:
        for p in range(len(text) - size + 1):
            piece = text[p : p + size]
            first[piece] = min(first.get(piece, i), i)
    out = []
    for i, text in docs:
        covered = np.zeros(len(text) + 1, bool)
        for p in range(len(text) - size + 1):
            if first[text[p : p + size]] < i:
                covered[p : p + size] = True
        kept = bytes(b for b, c in zip(text, covered) if not c)
        runs = int((covered[1:] & ~covered[:-1]).sum() + covered[0])
        out.append((i, len(text), int(covered.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_repeats_are_removed_from_later_documents(spark):
    rng = random.Random(11)

    def noise(n, letters="abcdé \n漢"):
        return "".join(rng.choice(letters) for _ in range(n))

    passage, line = noise(130), "x" * 90
    rows = []
    for n in range(70):
        parts = [noise(rng.randrange(0, 120))]
        if n % 3 == 0:
            parts.append(passage[rng.randrange(0, 60) :])
        if n % 5 == 0:
            parts.append(line[: rng.randrange(40, 90)])
        if n % 7 == 0:
            parts.append(noise(60, "ab") * 2)
        parts.append(noise(rng.randrange(0, 60)))
        rows.append((n, "".join(parts), "s", "c"))
    rows += [(n, rows[0][1], "s", "c") for n in (90, 91, 92)] + [(80, "short", "s", None), (81, "short", "s", None)]
    rows += [(70, None, "s", None), (71, "", "s", None), (72, passage, "s", None), (72, passage, "s", None)]
    rng.shuffle(rows)
    out = repeat_index.remove_repeats(frame(spark, rows))
    want = brute_repeats([(i, (t or "").encode()) for i, t, *_ in rows])
    assert sorted(map(tuple, out.collect())) == want
    assert repeat_index.remove_repeats(frame(spark, [])).count() == 0


def test_run_index_against_brute_force(monkeypatch):
    monkeypatch.setattr(repeat_index, "BLOCK", 300)
    rng = random.Random(5)
    for _ in range(25):
        base = bytes(rng.choice(b"ab") for _ in range(200)) + b"z" * 120
        cuts = [sorted((rng.randrange(260), rng.randrange(1, 300))) for _ in range(7)]
        texts = list({base[a : b + 10] for a, b in cuts})
        ids = np.array([rng.randrange(9) for _ in texts])
        index = repeat_index.RunIndex(texts)
        joined = b"\0".join(texts) + b"\0"
        assert index.run_lengths.sum() == len(joined) and len(index.run_symbols) <= len(joined)
        got, first, at = repeat_index.first_holders(texts, ids), {}, 0
        for t, i in zip(texts, ids):
            for p in range(len(t) - 49):
                first[t[p : p + 50]] = min(first.get(t[p : p + 50], 99), i)
        for t in texts:
            assert [got[at + p] for p in range(len(t) - 49)] == [first[t[p : p + 50]] for p in range(len(t) - 49)]
            at += len(t) + 1
        data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
        hashes, seen = {}, 0
        for _, start, windows, value in zip(*repeat_index.stretches(data, ends)):
            for p in range(start, start + windows):
                assert hashes.setdefault(data[p : p + 50].tobytes(), value) == value
                seen += 1
        assert seen == sum(max(0, len(t) - 49) for t in texts)


# ---- near duplicates -------------------------------------------------------------


def shingle_set(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_components(rows):
    sets = [(i, shingle_set(t)) for i, t, *_ in rows]
    roots = Roots()
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                roots.join(i, j)
    return sorted((i, len(s), roots.of(i)) for i, s in sets)


def near_rows():
    rng = random.Random(8)
    vocabulary = [f"w{n}" for n in range(300)] + ["Ünï", "THE", "a.b"]
    base = [[rng.choice(vocabulary) for _ in range(n)] for n in (6, 9, 24, 60, 60, 150)]
    rows = []
    for n in range(150):
        words = list(base[n % 6])
        for _ in range(rng.randrange(0, 1 + len(words) // 20)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((n, rng.choice([" ", "\n", "\t "]).join(words), "s", "c"))
    rows += [(200 + n, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 40))), "s", None) for n in range(60)]
    rows += [(300, None, "s", None), (301, "", "s", None), (302, " \n", "s", None), (303, "one TWO", "s", None), (304, "ONE two", "s", None)]
    return rows


def test_components_lose_no_link(spark, monkeypatch):
    rows = near_rows()
    want = brute_components(rows)
    for block, leaf in ((1024, 24), (8, 2)):
        monkeypatch.setattr(jaccard_join, "BLOCK", block)
        monkeypatch.setattr(jaccard_join, "LEAF", leaf)
        monkeypatch.setattr(jaccard_join, "FAMILY", block)
        monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", 10**6 if block > 8 else 0)
        got = sorted(map(tuple, jaccard_join.assign(frame(spark, rows)).collect()))
        assert got == want
    kept = {r.doc_id for r in jaccard_join.keep_first(frame(spark, rows)).collect()}
    assert kept == {i for i, _, c in want if i == c}
    assert jaccard_join.assign(frame(spark, [])).count() == 0


def test_tree_bounds_never_lose_a_link():
    hashes = WordHashes()
    sets = [jaccard_join.shingles((t or "").encode().split(), hashes) for _, t, *_ in near_rows()]
    rng = np.random.default_rng(4)
    sets = [s for s in sets if len(s)] + [np.unique(rng.integers(0, 1 << 62, 1500, dtype=np.uint64)) for _ in range(3)]
    sets.append(np.union1d(sets[-1], rng.integers(0, 1 << 62, 200, dtype=np.uint64)))
    linked = {(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))}
    points = [jaccard_join.count_vector(s) for s in sets]
    possible = jaccard_join.could_link(points, np.array([len(s) for s in sets]), np.zeros(len(sets), int))
    assert all(possible[i] and possible[j] for i, j in linked)
    assert possible[-1] and possible[-2] and not possible[-3] and not possible[-4]
    roots, mine = Roots(), Roots()
    for i, j in linked:
        roots.join(i, j)
    for i, j in jaccard_join.links(sets, np.zeros(len(sets), int)):
        assert (max(i, j), min(i, j)) in linked
        mine.join(i, j)
    assert all(roots.of(i) == mine.of(i) for i in range(len(sets)))


@pytest.mark.parametrize("percent", [75])
def test_rarest_part_meets_every_linking_set(percent):
    rng = np.random.default_rng(1)
    frequent = np.sort(rng.integers(0, 1 << 62, 20, dtype=np.uint64))
    for _ in range(200):
        a = np.unique(np.concatenate([rng.integers(0, 1 << 62, rng.integers(1, 40), dtype=np.uint64), frequent[: rng.integers(0, 20)]]))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.1], rng.integers(0, 1 << 62, 2, dtype=np.uint64)]))
        if 100 * len(np.intersect1d(a, b)) >= percent * len(np.union1d(a, b)):
            assert len(np.intersect1d(jaccard_join.rarest(a, frequent), jaccard_join.rarest(b, frequent)))


def block_pairs(sets):
    """Pairs of sets that share a block, by the task functions of the join."""

    class Frequent:
        value = np.zeros(0, np.uint64)

    texts = [" ".join(words).encode() for words in sets]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], names=["text"])
    sent = pa.Table.from_batches(list(jaccard_join._emit_rarest(4, Frequent())(iter([batch]))))
    out = set()
    for shard in set(sent["shard"].to_pylist()):
        rows = jaccard_join._blocks(sent.filter(pc.equal(sent["shard"], shard))).to_pylist()
        blocks = {}
        for r in rows:
            blocks.setdefault(r["key"], set()).add(r["ref"])
        out.update(p for b in blocks.values() for p in itertools.combinations(sorted(b), 2))
    return out


def test_blocks_keep_linking_pairs_and_few_others():
    """A pair is kept where its first common shingle leaves room for the overlap, a chance one at the end is not."""
    rng = random.Random(3)
    common = [[f"c{n}w{k}" for k in range(5)] for n in range(300)]  # some early, some late in the order of shingles
    docs = []
    for n in range(120):
        own = [f"d{n}w{k}" for k in range(70)]
        docs.append(own[:30] + sum(rng.sample(common, 4), []) + own[30:])
        if n % 3 == 0:
            near = list(docs[-1])
            for _ in range(rng.randrange(3)):
                near[rng.randrange(len(near))] = f"x{rng.random()}"
            docs.append(near[: rng.randrange(len(near) - 8, len(near) + 1)])
    hashes = WordHashes()
    sets = [jaccard_join.shingles([w.encode() for w in d], hashes) for d in docs]
    refs = [jaccard_join._ref(jaccard_join.set_digest(s)) for s in sets]
    kept, linked, shown = block_pairs(docs), set(), set()
    for i, j in itertools.combinations(range(len(docs)), 2):
        pair = tuple(sorted((refs[i], refs[j])))
        both = len(np.intersect1d(sets[i], sets[j]))
        if refs[i] != refs[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
            linked.add(pair)
        none = np.zeros(0, np.uint64)
        if len(np.intersect1d(jaccard_join.rarest(sets[i], none), jaccard_join.rarest(sets[j], none))):
            shown.add(pair)
    assert linked and linked <= kept
    assert 4 * len(kept - linked) < 3 * len(shown - linked)


def test_partners_of_a_block_are_found_at_any_size():
    rng = np.random.default_rng(6)
    for size in (3, 40, 600):
        n = np.sort(rng.integers(50, 100, size))
        most = jaccard_join.largest_partner(n, rng.integers(0, jaccard_join.prefix(n)))
        want = ((n[:, None] <= most) & (n <= most[:, None]) & ~np.eye(size, dtype=bool)).any(axis=1)
        got = jaccard_join.partnered(n, most)
        assert (got | ~want).all() and (got & ~want).sum() <= (size > 256)


def test_texts_are_staged_once_for_near_copies(spark, monkeypatch):
    """Rows keep their text inside the document only; it stood there a second time before."""
    columns = {}
    plain = jaccard_join.stage

    def noted(df, label):
        columns.setdefault(label, df.columns)
        return plain(df, label)

    monkeypatch.setattr(jaccard_join, "stage", noted)
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (None, None)], "doc_id long, text string")
    assert jaccard_join.keep_first(docs).count() == 2
    assert columns["join-rows"] == ["_doc", "_row"]


def test_packed_arrays_come_back():
    rng = np.random.default_rng(4)
    values = np.sort(rng.integers(0, 1 << 64, 500, dtype=np.uint64))
    again = unpacked(packed(np.diff(values, prepend=np.uint64(0))), np.uint64)
    assert (np.cumsum(again, dtype=np.uint64) == values).all()
    assert len(unpacked(packed(values[:0]), np.uint64)) == 0


def test_rows_that_repeat_an_id_are_judged_by_their_own_text(spark):
    text = " ".join(f"w{n}" for n in range(40))
    rows = [(1, text, 0), (5, text + " more", 1), (5, "quite another text of six words", 2), (5, text, 3), (None, text, 4)]
    rows += [(None, None, 5), (7, "", 6), (1, text, 7), (9, "long " * 300_000, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` int").repartition(2)
    kept = sorted(r["a.b"] for r in jaccard_join.keep_first(docs).collect())
    assert kept in ([0, 2, 5, 6, 8], [2, 5, 6, 7, 8])


def test_a_large_family_collapses_without_pairs_of_parts(spark, monkeypatch):
    """50,000 near copies share blocks; no table of the join may outgrow the members by much."""
    sizes = {}
    plain = jaccard_join.stage

    def counted(df, label):
        out = plain(df, label)
        sizes[label] = max(sizes.get(label, 0), out.count())
        return out

    monkeypatch.setattr(jaccard_join, "stage", counted)
    base = F.array(*[F.lit(f"w{n}") for n in range(30)])
    own = F.concat(F.lit("x"), F.col("id").cast("string"))
    docs = spark.range(50_000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", base, own).alias("text"))
    found = jaccard_join.assign(docs)
    assert found.where("component_id <> 0").isEmpty() and found.count() == 50_000
    assert max(sizes.values()) <= 50_000 * jaccard_join.rarest(np.arange(27), np.zeros(0)).size
    assert sizes.get("join-part-pairs", 0) == 0


def test_unrelated_members_of_a_large_block_meet_over_parts(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    rng = random.Random(12)
    rows = []
    for n in range(60):
        words = ["all", "share", "these", "five", "words"] + [f"v{rng.randrange(60)}" for _ in range(3)]
        rows.append((n, " ".join(words), "s", None))
    assert sorted(map(tuple, jaccard_join.assign(frame(spark, rows)).collect())) == brute_components(rows)


def test_common_beginnings_are_found_in_steps_of_eight_bytes(monkeypatch):
    rng = np.random.default_rng(5)
    for letters in (1, 2, 256):
        texts = [bytes(rng.integers(0, letters, n, dtype=np.uint8)) for n in rng.integers(50, 90, 30)]
        index = repeat_index.RunIndex(texts)
        joined = b"".join(t + b"\0" for t in texts)
        rest = [joined[p : p + index.to_stop[p]] for p in range(index.size)]
        a, b = rng.integers(0, index.size, (2, 3000))
        steps = []
        flat = np.searchsorted
        monkeypatch.setattr(np, "searchsorted", lambda *x: steps.append(1) or flat(*x))
        got = index._shared(np.frombuffer(joined, np.uint8), a, b).tolist()
        monkeypatch.undo()
        for i, j, n in zip(a.tolist(), b.tolist(), got):
            least = min(len(rest[i]), len(rest[j]))
            assert n == next((k for k in range(least) if rest[i][k] != rest[j][k]), least)
        assert 1 <= len(steps) <= 12  # by single bytes it took up to 89
