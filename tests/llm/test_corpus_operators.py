"""The corpus operators on small tables with every odd case, against brute force."""

import math
import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidegauge.llm import (
    embedding_dedup,
    exact_dedup,
    language,
    mixing,
    ngram_join,
    packing,
    quality,
    substring_dedup,
    token_files,
    tokens,
    url_filter,
)
from tidegauge.llm.components import connected_components
from tidegauge.llm.queries import QUERIES

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
# A docs table with columns that clash with what the operators name their own.
SCHEMA = "doc_id long, text string, lang string, source string, kept boolean, id string, row int, digest string, words int, score double"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


def words(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdefghilmnoprstu", k=rng.randint(2, 9))) for _ in range(n)]


def make(spark, rows):
    """(doc_id, text) or (doc_id, text, lang) rows as a table; the other columns are null or odd."""
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else None, None, None, "x", 1, None, None, 0.5) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    base = words(400, 1)
    edited = [*base[:100], "other", *base[101:]]
    long = " ".join(words(30_000, 2))
    rows = [
        (1, " ".join(base)),
        (2, " ".join(base)),
        (3, " ".join(edited)),
        (4, " ".join(base).upper()),
        (5, None),
        (6, ""),
        (7, " \n\t "),
        (8, "two words"),
        (9, "two words"),
        (9, "two words"),
        (None, "two words"),
        (None, None),
        (10, long),
        (11, long + " more"),
        (12, "ÄÖ ñ — 日本 <|endoftext|> it's 42!"),
        (13, "äÖ ñ — 日本 <|endoftext|> it's 42!"),
        (14, "..."),
    ]
    return make(spark, rows)


@pytest.fixture(scope="module")
def none(spark):
    return make(spark, [])


def collected(df):
    return [tuple(r) for r in df.collect()]


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_exact_groups(spark, odd, none):
    rows = collected(odd.select("doc_id", "text"))
    groups = defaultdict(list)
    for i, t in rows:
        groups[fold(t)].append(i)
    for heavy_rows in (2, 64):  # decided by broadcast or by shuffle alike
        found = exact_dedup.exact_groups(odd, heavy_rows=heavy_rows).collect()
        assert len(found) == len(rows)
        best = {k: max((i for i in v if i is not None), default=None) for k, v in groups.items()}
        assert Counter((r.doc_id, r.keep_id, r.group_size) for r in found) == Counter(
            (i, best[k], len(v)) for k, v in groups.items() for i in v
        )
        assert sum(r.kept for r in found) == len(groups)
        assert all(r.doc_id == r.keep_id for r in found if r.kept)
    kept = exact_dedup.exact_dedup(odd)
    assert kept.columns == COLUMNS and kept.count() == len(groups)
    assert exact_dedup.exact_groups(none).count() == 0 and exact_dedup.exact_dedup(none).columns == COLUMNS


def test_exact_groups_under_a_hot_text(spark):
    docs = make(spark, [(i, "Hot" if i % 3 else f"t{i}") for i in range(3000)])
    found = exact_dedup.exact_groups(docs).collect()
    assert sum(r.kept for r in found) == 1001 and {r.group_size for r in found} == {1, 2000}


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(60)]
    edges += [(5, 5), (None, 4), (7, None)] + edges[:10]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    found = dict(collected(connected_components(spark.createDataFrame(edges, "a long, b long"))))
    assert found == {x: root(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/")]


def test_urls(spark):
    urls = [
        (1, "http://a.example.com/en/1"),
        (2, "https://www.EXAMPLE.com/en/2#x"),
        (3, "http://plain.org/start"),
        (4, "http://alias.org/x?q=1"),
        (5, "http://far.org/y"),
        (6, None),
        (7, "no scheme/en/"),
        (8, "http://xcom/"),
        (9, "http://b.com"),
        (10, "http://shop.net/es/?a"),
        (10, "http://shop.net/es/?a"),
        (None, "http://far.org/y"),
        (11, "http://good.com/page"),
        (12, "http://rel.org/a/b.html"),
        (13, "http://" + "h" * 20000 + ".net/es/" + "p" * 50000),
    ]
    html = {
        3: '<LINK href="http://alias.org/x?q=1" rel=canonical>',
        4: "<meta http-equiv='refresh' content='0; url=//shop.net/es/?a'>",
        11: '<link rel="canonical" href="http://shop.net/es/?a">',
        12: '<link rel="canonical" href="../b.html"><link rel="canonical" href="#top"><link rel=canonical href=mailto:x>',
    }
    pages = spark.createDataFrame([(i, u, html.get(i), "x", 1) for i, u in urls], "page_id long, url string, html string, host string, rule int")
    rules = url_filter.parse_rules(spark, RULES)
    redirects = spark.createDataFrame([("http://far.org/y", "https://PLAIN.org/start#z"), (None, "http://a.com/"), ("x", None)], "source string, target string")
    found = {(r.page_id, r.rule, r.verdict) for r in url_filter.judge_urls(pages, rules, redirects).collect()}
    assert found == {
        (1, "example.com/en/", "block"),
        (2, "www.example.com/en/", "allow"),
        (3, None, "block"),  # by its canonical link and that page's redirect
        (4, None, "block"),
        (5, None, "block"),  # by the given redirect
        (6, None, "allow"),
        (7, None, "allow"),
        (8, None, "allow"),
        (9, None, "allow"),
        (10, "net/es/", "block"),
        (None, None, "block"),
        (11, "com/", "allow"),  # its own rule comes before its aliases
        (12, None, "allow"),
        (13, "net/es/", "block"),
    }
    assert url_filter.judge_urls(pages, rules, redirects).count() == len(urls)
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0


def test_hosts_of_many_labels(spark):
    deep = "https://" + "a." * 100_000 + "example.com/en/x"
    pages = spark.createDataFrame([(1, deep, None), (2, "http://www.example.com/en/", None), (3, "x://a..net/es/", None), (4, "x://com/", None)], "page_id long, url string, html string")
    found = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge_urls(pages, url_filter.parse_rules(spark, RULES)).collect()}
    assert found == {1: ("example.com/en/", "block"), 2: ("www.example.com/en/", "allow"), 3: ("net/es/", "block"), 4: ("com/", "allow")}


def test_chains_of_canonical_links(spark):
    """Random chains and trees of links over many pages, against a plain walk."""
    rng = random.Random(17)
    hosts = ["a.org", "b.org", "www.example.com", "c.example.com", "d.net"]
    urls = [f"http://{rng.choice(hosts)}/{rng.choice(['en', 'es', 'x'])}/{i}" for i in range(300)]
    target = {i: rng.randrange(i) for i in range(1, 300) if rng.random() < 0.6}
    rows = [(i, u, f'<link rel="canonical" href="{urls[target[i]]}">' if i in target else "<p>") for i, u in enumerate(urls)]
    parent = list(range(300))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in target.items():
        parent[root(i)] = root(j)
    alias = defaultdict(list)
    for i in range(300):
        alias[root(i)].append(i)

    def rule(url):
        host, _, path = url[7:].partition("/")
        fits = [(len(t), t, v) for v, t in RULES if (host == t.partition("/")[0] or host.endswith("." + t.partition("/")[0])) and ("/" + path).startswith("/" + t.partition("/")[2])]
        return max(fits)[1:] if fits else (None, None)

    want = {}
    for i, u in enumerate(urls):
        name, verdict = rule(u)
        tainted = any(rule(urls[j])[1] == "block" for j in alias[root(i)])
        want[i] = (name, verdict or ("block" if tainted else "allow"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = url_filter.judge_urls(pages, url_filter.parse_rules(spark, RULES)).collect()
    assert {r.page_id: (r.rule, r.verdict) for r in found} == want


def test_given_pages_have_no_links(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert url_filter.link_edges(pages).count() == 0


def expected_ids(tokenizer, rows):
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, tokens.END_ID] for _, t in rows]


def test_piece_encoder_equals_the_tokenizer():
    import pyarrow as pa

    coder, tokenizer = tokens.PieceEncoder(TOKENIZER, remembered=300), Tokenizer.from_file(TOKENIZER)
    assert coder.by_piece
    rng = random.Random(5)
    parts = ["the", "The", "d'être", "l'reine", "it's'", ",'s", "''t", "É", "ß", "×", "¿qué?", "é", "H̱", "İ", "ΣΑΣ", "9", "日本", "\x1c", "\xa0", "\x85", "<|endoftext|>", "<|ENDOFTEXT|>", "***", "\x00", "ªº", "—,"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", "\n", "\t "]) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    for batch in (texts, [t for t in texts if t.isascii()], [None, ""], []):
        ids, counts = coder.encode(pa.array(batch, pa.string()))
        want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in batch]
        assert counts.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


def test_token_files(spark, odd, none):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    manifest = token_files.write_token_files(odd, TOKENIZER, sequence=16, batch_sequences=4, docs_per_shard=6)
    found = token_files.read_token_files(manifest).orderBy("start").collect()
    rows = collected(odd.select("doc_id", "text"))
    want = Counter((i, len(x), zlib.crc32(np.array(x, "<u4"))) for (i, _), x in zip(rows, expected_ids(tokenizer, rows), strict=True))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == want
    order = [(-1 if r.doc_id is None else r.doc_id) for r in found]
    assert order == sorted(order)
    assert [r.start for r in found] == [0, *np.cumsum([r.n_tokens for r in found])[:-1].tolist()]
    for shard in manifest.collect():
        file = token_files.TokenFile(shard.folder, shard.file)
        masks = [file.sequence(i) for i in range(shard.n_sequences)]
        assert sum(m.true_count for _, m in masks) == shard.n_tokens and all(len(t) == 16 for t, _ in masks)
        assert not masks[0][0].flags.owndata  # a view into the file
    assert token_files.token_digest(spark, none, TOKENIZER).count() == 0


def test_packing(spark, odd, none):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    rows = collected(odd.select("doc_id", "text"))
    found = packing.pack_documents(odd, TOKENIZER, capacity=64, group_pieces=100).collect()
    want = Counter()
    for (i, _), x in zip(rows, expected_ids(tokenizer, rows), strict=True):
        for a in range(0, len(x), 64):
            part = x[a : a + 64]
            want[i, a // 64, a, len(part), zlib.crc32(np.array(part, "<u4"))] += 1
    assert Counter(tuple(r)[:5] for r in found) == want
    bins = defaultdict(list)
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert len(bins) <= math.ceil(sum(k[3] * n for k, n in want.items()) / 64) + 1
    assert packing.pack_documents(none, TOKENIZER).count() == 0


def test_repacking_reaches_the_bound(spark):
    rng = random.Random(8)
    sizes = [rng.randint(1, 1500) for _ in range(3000)]
    pieces = spark.createDataFrame(list(enumerate(sizes)), "rid long, length long")
    one = packing.pack_pieces(pieces, group_pieces=100, gaps=()).select("sequence_id").distinct().count()
    more = packing.pack_pieces(pieces, group_pieces=100).select("sequence_id").distinct().count()
    least = packing.lower_bound(*np.unique(sizes, return_counts=True), 4096)
    assert least <= more < one and more <= least + 2


def test_lower_bound_and_best_fit():
    assert packing.lower_bound(np.array([2100]), np.array([7]), 4096) == 7
    assert packing.lower_bound(np.array([1400]), np.array([7]), 4096) == 4  # two fit, not three
    assert packing.lower_bound(np.array([]), np.array([]), 4096) == 0
    bins, offsets, gaps = packing.best_fit_decreasing(np.array([6, 5, 4, 3, 2]), 10)
    assert len(set(bins.tolist())) == 2 and gaps.tolist() == [0] * 5


def test_languages(spark, odd, none):
    rng = random.Random(4)
    voice = {"en": ["the", "and", "with", "thing"], "fr": ["que", "être", "leaux", "ment"], "de": ["der", "sch", "ung", "über"]}
    rows = [(i, " ".join(rng.choices(voice[lang], k=rng.randint(5, 60))), lang) for i, lang in enumerate(rng.choices(list(voice), k=300))]
    rows += [(1000, None, "en"), (1001, "123 !!", "fr"), (1002, "the thing", None), (None, "der über", "de"), (1003, "", "en"), (1003, "", "en")]
    found = language.identify_languages(make(spark, rows)).collect()
    assert len(found) == len(rows)
    truth = {r[0]: r[2] for r in rows[:300]}
    assert all(r.lang_pred == truth[r.doc_id] for r in found if r.doc_id in truth)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    other = {r.doc_id: (r.lang_pred, r.score) for r in found if r.doc_id not in truth}
    assert other[1000] == other[1001] == other[1003] == ("und", 0.0)
    assert other[1002][0] == "en" and other[None][0] == "de" and all(0 <= r.score <= 1 for r in found)
    assert {r.lang_pred for r in language.identify_languages(odd).collect()} == {"und"}  # nothing to learn from
    assert language.identify_languages(none).count() == 0
    kept = language.keep_identified(make(spark, rows))
    assert kept.columns == COLUMNS and kept.count() == len(rows) - 4


def test_profile_distance():
    assert language.ranked("ab ab", 3).tolist() == sorted(language.ranked("ab ab", 3).tolist())  # all twice: by code
    profiles = language.Profiles.of([("x", int(c), i) for i, c in enumerate(language.ranked("ab ab", 5))], 5)
    assert profiles.nearest("AB ab") == ("x", 1.0) and profiles.nearest("...") == ("und", 0.0)
    assert profiles.nearest("q") == ("x", 0.0)


def shingle_set(text):
    w = (text or "").lower().split()
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def near_copies(seed, groups, size):
    rng = random.Random(seed)
    out = []
    for g in range(groups):
        base = words(rng.randint(30, 300), f"{seed}-{g}")
        for _ in range(rng.randint(1, size)):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = "changed"
            out.append(" ".join(copy))
    return out


@pytest.fixture(scope="module")
def near(spark, odd):
    return make(spark, collected(odd.select("doc_id", "text")) + [(100 + i, t) for i, t in enumerate(near_copies(6, 40, 6))])


def test_ngram_join(spark, near, none):
    rows = near_rows = collected(near.select("doc_id", "text"))
    sets = [shingle_set(t) for _, t in rows]
    links, parent = Counter(), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if jaccard(sets[a], sets[b]) >= 0.8:
            links[a] += 1
            links[b] += 1
            parent[root(a)] = root(b)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[root(i)].append(d)
    want = Counter((d, links[i], min((x for x in least[root(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows))
    found = ngram_join.near_duplicates(near).collect()
    exact = ngram_join.near_duplicates(near, recall=0.99999).collect()
    assert Counter((r.doc_id, r.n_links, r.class_id) for r in exact) == want
    missed = want - Counter((r.doc_id, r.n_links, r.class_id) for r in found)
    assert sum(missed.values()) <= 0.02 * len(near_rows)
    assert not any(r.n_links > links[i] for i, (d, _) in enumerate(rows) for r in found if r.doc_id == d and d not in (None, 9))
    kept = ngram_join.without_near_duplicates(near)
    assert kept.columns == COLUMNS and kept.count() == sum(r.kept for r in found)
    assert ngram_join.near_duplicates(none).count() == 0


def test_large_group_of_near_copies(spark):
    """A bucket of many blocks: all links are counted, though no pair is written."""
    base = words(200, 9)
    rows = [(i, " ".join([*base[:i % 190], f"w{i}", *base[i % 190 :]])) for i in range(700)]
    found = ngram_join.near_duplicates(make(spark, rows)).collect()
    assert {(r.n_links, r.class_id) for r in found} == {(699, 0)} and sum(r.kept for r in found) == 1


def test_repeated_passages(spark, odd, none):
    rng = random.Random(10)
    passages = [words(rng.randint(26, 90), f"p{i}") for i in range(30)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(1, 4)):
            p = list(rng.choice(passages)) if rng.random() < 0.5 else words(40, rng.random())
            if rng.random() < 0.3:
                p[rng.randrange(len(p))] = "changed"
            parts += [" ".join(p), "short line"]
        rows.append((i, "\n".join(parts)))
    docs = make(spark, rows + [(900, None), (901, ""), (902, "\n\n")])
    spots = {(d, i): shingle_set(x) for d, t in rows for i, x in enumerate(t.split("\n")) if len(x.split()) >= 25}
    parent = {k: k for k in spots}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(spots, 2):
        if jaccard(spots[a], spots[b]) >= 0.8:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    size = Counter(root(k) for k in spots)
    want = {k: root(k) for k in spots if size[root(k)] > 1}
    found = substring_dedup.repeated_passages(docs).collect()
    assert {(r.doc_id, r.para): (r.keep_doc_id, r.keep_para) for r in found} == want
    texts = dict(rows)
    assert all(texts[r.doc_id][r.start : r.start + r.length] == texts[r.doc_id].split("\n")[r.para] for r in found)
    clean = substring_dedup.without_repeats(docs)
    gone = {k for k, first in want.items() if k != first}
    assert clean.columns == COLUMNS
    left = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in rows}
    assert dict(collected(clean.select("doc_id", "text"))) == left | {900: None, 901: "", 902: "\n\n"}
    assert substring_dedup.repeated_passages(none).count() == 0
    assert {r.doc_id for r in substring_dedup.repeated_passages(odd).collect()} == {1, 2, 3, 4, 10, 11}


def test_large_group_leaves_the_recall_of_other_links(spark):
    """Links at the threshold are found beside a large group of very similar texts."""
    base = words(200, 31)
    rows = [(i, " ".join([*base[: i % 190], f"w{i}", *base[i % 190 :]])) for i in range(400)]
    for i in range(500):
        same = words(84, f"s{i}")
        rows += [(1000 + 2 * i + k, " ".join(same + words(10, f"t{i}{k}"))) for k in range(2)]
    found = ngram_join.near_duplicates(make(spark, rows)).where("doc_id >= 1000 and n_links = 1").count()
    assert found >= 0.99 * 1000


def test_depths_differ_by_what_was_found(spark):
    """Texts with only strong links end at the longest prefix; those without, or with weaker ones, go on to the last depth."""
    base = words(200, 31)
    rows = [(i, " ".join([*base[: i % 190], f"w{i}", *base[i % 190 :]])) for i in range(60)]
    for i in range(60):
        same = words(84, f"s{i}")
        rows += [(1000 + 2 * i + k, " ".join(same + words(10, f"t{i}{k}"))) for k in range(2)]
    rows += [(5000 + i, " ".join(words(50, f"lone{i}"))) for i in range(20)] + [(9000, None)]
    found = {r.doc_id: r.depth for r in ngram_join.near_duplicates(make(spark, rows)).collect()}
    last = ngram_join.last_depth(0.8, ngram_join.RECALL, ngram_join.TREES, ngram_join.DEPTH)
    assert last < ngram_join.DEPTH and found.pop(9000) is None
    assert {d for i, d in found.items() if i < 1000} == {ngram_join.DEPTH}
    assert {d for i, d in found.items() if i >= 1000} == {last}


def test_an_ended_search_still_answers_others(spark):
    """A text near the threshold of one of a group of strong copies is found, though the copies' own searches have ended."""
    rng, rows = random.Random(12), []
    for g in range(150):
        base = words(100, f"g{g}")
        rows += [(10 * g + k, " ".join([*base[:-1], f"k{k}"])) for k in range(3)]
        rows.append((10 * g + 9, " ".join(base[:-11] + words(10, f"far{g}{rng.random()}"))))
    links = 0
    for r in ngram_join.near_duplicates(make(spark, rows)).collect():
        links += r.doc_id % 10 == 9 and r.n_links == 3
    assert links >= 0.98 * 150


def test_collisions_of_active_members(spark):
    from tidegauge.llm.units import collisions

    rows = [(c, 0, b, c % 7 == 0) for b in range(3) for c in range(100 * b, 100 * b + 60)] + [(c, 0, 9, False) for c in range(40)]
    units = collisions(spark.createDataFrame(rows, "cid long, table int, bucket long, active boolean"), block=8).collect()
    met = Counter()
    by_unit = defaultdict(list)
    for u in units:
        by_unit[u.unit].append((u.cid, u.side))
    for members in by_unit.values():
        for (a, x), (b, y) in combinations(sorted(members), 2):
            if x == 2 or x != y:
                met[a, b] += 1
    want = {(a, b) for s in range(3) for a, b in combinations(range(100 * s, 100 * s + 60), 2) if a % 7 == 0 or b % 7 == 0}
    assert want <= set(met) and all(met[p] == 1 for p in want)


def test_collisions_of_many_active_members_and_few_others(spark):
    """Members that are not active have a block, however few they are beside the active ones."""
    from tidegauge.llm.units import collisions

    sizes = [(a, r) for a in (1, 7, 8, 9, 16, 17, 25, 40, 65, 73) for r in (0, 1, 2, 3, 9)]
    rows = [(1000 * b + c, 0, b, c < a) for b, (a, r) in enumerate(sizes) for c in range(a + r)]
    met, blocks = Counter(), Counter()
    by_unit = defaultdict(list)
    for u in collisions(spark.createDataFrame(rows, "cid long, table int, bucket long, active boolean"), block=8).collect():
        by_unit[u.unit].append((u.cid, u.side))
        blocks[u.cid] += 1
    for members in by_unit.values():
        for (a, x), (b, y) in combinations(sorted(members), 2):
            if x == 2 or x != y:
                met[a, b] += 1
    for b, (a, r) in enumerate(sizes):
        want = {(1000 * b + c, 1000 * b + d) for c, d in combinations(range(a + r), 2) if c < a}
        assert all(met[p] == 1 for p in want)
        if a + r > 1:
            active, rest = -(-a // 8), -(-r // 8)
            assert {blocks[1000 * b + c] for c in range(a)} == {active + rest}
            assert {blocks[1000 * b + c] for c in range(a, a + r)} <= {active}


def test_ngram_join_of_large_groups_with_few_done(spark, monkeypatch):
    """Blocks of few texts do what large blocks do in larger groups: texts that are done lie beside many that go on."""
    from tidegauge.llm.units import gathered

    rng, rows = random.Random(12), []
    for g in range(12):
        base = words(300, f"large{g}")
        for i in range(rng.randint(8, 30)):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 5])):
                copy[rng.randrange(300)] = f"w{g}x{i}"
            rows.append((len(rows), " ".join(copy)))
        rows.append((len(rows), " ".join(base[:-32] + words(32, f"far{g}"))))
    sets = [shingle_set(t) for _, t in rows]
    links = Counter()
    for a, b in combinations(range(len(rows)), 2):
        if jaccard(sets[a], sets[b]) >= 0.8:
            links.update((a, b))
    monkeypatch.setattr(ngram_join, "gathered", lambda members: gathered(members, block=4))
    found = ngram_join.near_duplicates(make(spark, rows)).collect()
    assert {r.depth for r in found} == {6, 7}
    assert len(found) == len(rows) and all(r.n_links <= links[r.doc_id] for r in found)
    assert sum(r.n_links for r in found) >= 0.99 * sum(links.values())


def test_gathered_members_meet_once(spark):
    """The pairs that share a bucket, with an active member, are each met once, and members of the same buckets are laid out once."""
    from tidegauge.llm.units import collisions, gathered

    rng = random.Random(30)
    rows = []
    for g in range(40):
        size, apart = rng.randint(2, 30), rng.random() * 0.5
        for t in range(6):
            rows += [(100 * g + c, t, 1000 * g + 10 * t, c % 5 != 1 or g % 3 == 0) for c in range(size) if rng.random() > apart]
    rows += [(100 * g + rng.randrange(20), 6, 90_000 + g % 4, True) for g in range(40)] + [(5000 + c, 0, 99_000, False) for c in range(9)]
    rows = sorted(set(rows))
    active = {c: a for c, _, _, a in rows}
    rows = [(c, t, b, active[c]) for c, t, b, _ in rows]
    held = defaultdict(set)
    for c, _, b, _ in rows:
        held[b].add(c)
    want = {p for m in held.values() for p in combinations(sorted(m), 2) if active[p[0]] or active[p[1]]}
    members = spark.createDataFrame(rows, "cid long, table int, bucket long, active boolean")
    for block in (4, 256):
        by_unit, met = defaultdict(list), Counter()
        units = gathered(members, block=block).collect()
        for u in units:
            by_unit[u.unit].append((u.cid, u.side, u.leader, u.table, u.bucket))
        for unit in by_unit.values():
            assert len({x[3:] for x in unit}) == 1
            for (a, x, k, t, _), (b, y, m, _, _) in combinations(sorted(unit), 2):
                # What minhash.verified asks of a pair.
                if (x == 2 or x != y) and (a, b) in want and (t < 0 or k != m and t == min(s for c, s, q, _ in rows if c == a and b in held[q])):
                    met[a, b] += 1
        assert met == Counter(want)
        if block == 256:
            assert len(units) < collisions(members).count() and {u.table < 0 for u in units} == {True, False}


def test_runs_inside_and_across_lines(spark):
    """A passage of over 50 words is found wherever it begins and ends, and however its lines are broken."""
    rng = random.Random(21)
    rows, spliced = [], []
    for i in range(40):
        passage = words(rng.randint(51, 120), f"run{i}")
        spliced.append(passage)
        for copy in range(2):
            text = words(rng.randint(5, 40), f"a{i}{copy}") + passage + words(rng.randint(5, 40), f"b{i}{copy}")
            breaks = rng.choice([12, 20, 1000])
            rows.append((2 * i + copy, "\n".join(" ".join(text[k : k + breaks]) for k in range(0, len(text), breaks))))
    docs = make(spark, rows)
    found = [r for r in substring_dedup.repeated_passages(docs, runs=True).collect() if r.para is None]
    texts = dict(rows)
    removed = {r.doc_id: texts[r.doc_id][r.start : r.start + r.length].split() for r in found if not r.kept}
    assert removed == {2 * i + 1: p for i, p in enumerate(spliced)}
    assert {r.doc_id: texts[r.doc_id][r.start : r.start + r.length].split() for r in found if r.kept} == {2 * i: p for i, p in enumerate(spliced)}
    assert all(r.passage_rows == 2 and r.keep_doc_id == r.doc_id // 2 * 2 for r in found)
    clean = dict(collected(substring_dedup.without_repeats(docs, runs=True).select("doc_id", "text")))
    for i, p in enumerate(spliced):
        assert clean[2 * i] == texts[2 * i]
        rest = texts[2 * i + 1].split()
        at = next(k for k in range(len(rest)) if rest[k : k + len(p)] == p)
        assert clean[2 * i + 1].split() == rest[:at] + rest[at + len(p) :]


def test_bands_are_tuned_for_recall():
    for threshold in (0.6, 0.8, 0.9):
        bands, width = substring_dedup.tuned_bands(threshold)
        assert 1 - (1 - threshold**width) ** bands >= 0.99


def test_vectors(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(300, 16))
    rows = [x.tolist() for x in base]
    rows += [(base[i % 40] + rng.normal(size=16) * 0.1).tolist() for i in range(200)]
    rows += [rows[0], rows[0], (base[0] * 1e200).tolist(), (base[1] * 1e-200).tolist()]
    odd = [None, [], [0.0] * 16, [1.0, None, *[0.0] * 14], [float("nan")] * 16, [float("inf"), *[0.0] * 15], [1.0, 2.0], [2.0, 4.0]]
    data = [(i, v, "x") for i, v in enumerate(rows + odd)] + [(None, rows[2], "x"), (3, rows[3], "x")]
    found = embedding_dedup.near_duplicate_vectors(
        spark.createDataFrame(data, "vec_id long, embedding array<double>, cid string"), pivots=64
    ).collect()
    assert len(found) == len(data)

    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v) / max(abs(y) for y in v)
        return x / math.sqrt(x @ x)

    units = [unit(v) for _, v, _ in data]
    links = Counter()
    for a, b in combinations(range(len(data)), 2):
        if units[a] is not None and units[b] is not None and len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.95:
            links[a] += 1
            links[b] += 1
    got = Counter((r.vec_id, r.n_links) for r in found)
    want = Counter((d[0], links[i]) for i, d in enumerate(data))
    assert sum(r.n_links for r in found) >= 0.9 * sum(links.values())
    assert sum((want - got).values()) <= 0.1 * len(data)
    alone = {r.vec_id: r for r in found}
    for i in range(len(rows), len(rows) + 6):
        assert alone[i].n_links == 0 and alone[i].component_id == i and alone[i].kept
    assert alone[len(rows) + 7].component_id == len(rows) + 6
    assert embedding_dedup.near_duplicate_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_vectors_of_a_hundred_lengths(spark):
    rng = np.random.default_rng(8)
    rows = []
    for n in range(1, 101):
        x = rng.normal(size=n)
        rows += [x.tolist(), (2 * x).tolist(), (x + 0.01 * rng.normal(size=n)).tolist(), (-x).tolist()]
    found = embedding_dedup.near_duplicate_vectors(spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")).collect()
    unit = [np.array(r) / np.linalg.norm(r) for r in rows]
    want = {i: sum(float(unit[i] @ unit[j]) >= 0.95 for j in range(4 * (i // 4), 4 * (i // 4) + 4) if j != i) for i in range(400)}
    assert {r.vec_id: r.n_links for r in found} == want


@pytest.mark.parametrize("pivots", [64, 4096, 16384])
def test_descriptions_reach_their_recall(pivots):
    rng = np.random.default_rng(3)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    p, tried, fresh = (unit(rng.normal(size=(n, 64))) for n in (pivots, 400, 1000))
    nearest, shared = embedding_dedup.choose_description({64: (p, tried)}, 0.95)
    assert embedding_dedup.measured_recall(fresh, p, 0.95, ((nearest, shared),))[0] >= 0.98


def test_no_vector_pair_is_wrong_and_few_are_lost(spark):
    """Pairs around the threshold, in blocks of two: precision 1, recall 0.99."""
    rng = np.random.default_rng(9)
    rows, want = [], {}
    for i in range(1500):
        x = rng.normal(size=48)
        x /= np.linalg.norm(x)
        side = rng.normal(size=48)
        side -= (side @ x) * x
        side /= np.linalg.norm(side)
        cos = rng.uniform(0.93, 0.97)
        rows += [(2 * i, x.tolist()), (2 * i + 1, (cos * x + math.sqrt(1 - cos * cos) * side).tolist())]
    unit = np.array([r[1] for r in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    for i in range(1500):
        want[i] = float(unit[2 * i] @ unit[2 * i + 1]) >= 0.95
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r.vec_id: r for r in embedding_dedup.near_duplicate_vectors(docs).collect()}
    linked = {i for i in range(1500) if found[2 * i].component_id == found[2 * i + 1].component_id}
    assert all(want[i] for i in linked) and len(linked) >= 0.99 * sum(want.values())


def test_mixing(spark, odd, none):
    rng = random.Random(12)
    kinds = {"a": ["alpha", "apple", "axis"], "b": ["beta", "bread", "bone"], "c": ["gamma", "grape", "gate"]}
    names = rng.choices("abc", [6, 3, 1], k=600)
    rows = [(i, " ".join(rng.choices(kinds[k] + ["word"], k=rng.randint(5, 40)))) for i, k in enumerate(names)]
    labels = spark.createDataFrame(
        [(i, k, "x") for i, k in enumerate(names) if i % 2] + [(None, "a", "x"), (0, None, "x"), (9999, "b", "x"), (1, names[1], "x")],
        "doc_id long, domain string, text string",
    )
    docs = make(spark, rows + [(700, None), (701, ""), (None, "alpha apple")])
    found = mixing.document_rates(docs, labels, {"a": 0.4, "b": 0.4, "c": 0.2}).collect()
    assert len(found) == 603
    total = sum(r.tokens for r in found)
    assert total == sum(len(t.split()) for _, t in rows) + 2
    for k, share in (("a", 0.4), ("b", 0.4), ("c", 0.2)):
        assert abs(sum(r.tokens * r[f"p_{k}"] * r.rate for r in found) / total - share) < 0.02
    right = [max("abc", key=lambda k, r=r: r[f"p_{k}"]) == names[r.doc_id] for r in found if r.doc_id is not None and r.doc_id < 600]
    assert sum(right) / len(right) > 0.95
    assert all(r.rate >= 0 and r.copies in (math.floor(r.rate), math.floor(r.rate) + 1) for r in found)
    out = mixing.mixed_documents(docs, labels, {"a": 0.4, "b": 0.4, "c": 0.2})
    assert out.columns == COLUMNS and out.count() == sum(r.copies for r in found)
    # Without labels there is one domain, and its target is what it has.
    assert {round(r.rate, 6) for r in mixing.document_rates(odd, labels.limit(0), {"unknown": 1.0}).collect()} == {1.0}
    assert mixing.document_rates(none, labels, {"a": 1.0}).count() == 0


def test_small_posteriors_count_toward_targets(spark):
    """Targets that rates can meet are met by the posteriors returned, also where they lie below a step of the grid."""
    rng = random.Random(14)
    rows, labels = [], []
    for i in range(2000):
        kind = rng.random() < 0.7
        rows.append((i, " ".join(rng.choices(["alpha", "apple", "axis"] if kind else ["beta", "bread", "bone"], k=20))))
        labels.append((i, rng.choices("abc", [0.985, 0, 0.015] if kind else [0, 0.8, 0.2])[0]))
    docs, labels = make(spark, rows), spark.createDataFrame(labels, "doc_id long, domain string")

    def shares(found, rate):
        got = {k: sum(r.tokens * r[f"p_{k}"] * rate(r) for r in found) for k in "abc"}
        return {k: x / sum(got.values()) for k, x in got.items()}

    found = mixing.document_rates(docs, labels, {"a": 1.0}).collect()
    want = shares(found, lambda r: 0.5 if r.p_a > r.p_b else 2.0)
    got = shares(mixing.document_rates(docs, labels, want).collect(), lambda r: r.rate)
    assert all(abs(got[k] - want[k]) < 0.001 for k in "abc")


def test_poor_and_toxic_documents_get_lower_rates(spark):
    """The registered query mixes in less of documents labelled poor and of toxic ones that their words give away."""
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    insult = docs.where(F.lower("text").rlike(r"(^|\s)(trash|pathetic|idiot|disgusting|worthless|stupid|clown|loser|scum|moron)(\s|$)"))
    kind = F.when(F.col("insult"), "insult").when(F.col("quality") == 1, "good").otherwise("poor")
    marks = labels.join(insult.select("doc_id", F.lit(True).alias("insult")), "doc_id", "left")
    rates = QUERIES["op7_source_mixing"](spark, folder).join(marks, "doc_id")
    mean = {r.kind: r.rate for r in rates.groupBy(kind.alias("kind")).agg(F.avg("rate").alias("rate")).collect()}
    assert mean["poor"] < 0.5 * mean["good"] and mean["insult"] < 0.5 * mean["good"] and mean["good"] > 1.2


def test_rates_are_the_least_squares_solution(spark):
    """Where a target is out of reach the mix is the best that nonnegative rates can do."""
    cells = spark.createDataFrame([(64, 0, 100), (32, 32, 100), (0, 64, 0)], "q0 int, q1 int, tokens long")
    found = {r.q0: r.rate for r in mixing.fit_rates(cells, ["a", "b"], {"a": 0.25, "b": 0.75}, 200.0).collect()}
    # b gets half of the middle cell alone: rate of the pure cell falls to 0, the other balances the misses.
    assert found[64] == 0.0 and 2.0 <= found[32] <= 3.0


@pytest.mark.parametrize("n", [2, 4])
def test_rates_agree_with_a_solver(spark, n):
    """Projected-gradient steps in NumPy on the same cells, run to the end; reachable targets and targets out of reach."""
    rng = np.random.default_rng(n)
    p = rng.dirichlet(np.full(n, 0.3), 80)
    tokens = rng.integers(1, 1000, 80)
    names = [f"d{i}" for i in range(n)]
    cells = spark.createDataFrame(
        [(*[0] * n, int(t), *map(float, row)) for t, row in zip(tokens, p, strict=True)],
        ", ".join([*[f"q{i} int" for i in range(n)], "tokens long", *[f"m{i} double" for i in range(n)]]),
    )
    for weights in (rng.dirichlet(np.ones(n)), np.eye(n)[0]):
        total = float(tokens.sum())
        have, want, r = tokens @ p, weights * total, np.ones(80)
        for _ in range(100_000):
            r = np.maximum(0, r - (p @ (((tokens * r) @ p - want) / have) + mixing.RIDGE * (r - 1)) / (1 + mixing.RIDGE))
        found = mixing.fit_rates(cells, names, dict(zip(names, weights.tolist(), strict=True)), total).collect()
        mine = {tuple(round(x[f"m{i}"], 9) for i in range(n)): x.rate for x in found}
        assert max(abs(mine[tuple(round(x, 9) for x in row)] - y) for row, y in zip(p.tolist(), r, strict=True)) < 1e-3


def test_twenty_domains_are_mixed(spark):
    rng = random.Random(40)
    rows = [(i, " ".join(rng.choices([f"w{i % 20}a", f"w{i % 20}b", "common"], k=30))) for i in range(1000)]
    labels = spark.createDataFrame([(i, f"d{i % 20:02}") for i in range(1000)], "doc_id long, domain string")
    targets = {f"d{k:02}": 2.0 if k < 10 else 1.0 for k in range(20)}
    found = mixing.document_rates(make(spark, rows), labels, targets).collect()
    assert len(found) == 1000
    total = sum(r.tokens * r.rate for r in found)
    for k in range(20):
        assert abs(sum(r.tokens * r[f"p_d{k:02}"] * r.rate for r in found) / total - targets[f"d{k:02}"] / 30) < 0.002


def test_quality(spark, odd, none):
    rng = random.Random(13)
    good, bad = words(60, "g"), words(60, "b")
    marks = [rng.random() < 0.7 for _ in range(500)]
    rows = [(i, " ".join(rng.choices(good if m else bad, k=rng.randint(20, 60))) + ("" if m else "!!!")) for i, m in enumerate(marks)]
    labels = [(i, 1 if m else 0) for i, m in enumerate(marks) if i % 2] + [(None, 1), (2, None), (9999, 0), (1, int(marks[1]))]
    labels = spark.createDataFrame(labels, "doc_id long, label int")
    found = quality.score_quality(make(spark, rows + [(600, None), (601, ""), (None, "x")]), labels, rounds=1).collect()
    assert len(found) == 503 and all(0 <= r.score <= 1 for r in found)
    right = [r.keep == marks[r.doc_id] for r in found if r.doc_id is not None and r.doc_id < 500 and r.doc_id % 2 == 0]
    assert sum(right) / len(right) > 0.95
    assert {r.score for r in quality.score_quality(odd, labels.limit(0)).collect()} == {0.5}
    assert quality.score_quality(none, labels, rounds=1).count() == 0


def test_quality_learns_from_all_labels_and_all_confident_documents(spark, monkeypatch):
    """More labels than were once sampled: each fit sees all that are not kept apart, later ones all confident documents too."""
    n, labelled = 30_000, 27_600
    text = F.concat(F.when(F.col("id") % 3 == 0, "bad worse !!!").otherwise("good better best"), F.lit(" w"), F.col("id") % 5)
    docs = spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text"))
    labels = spark.range(labelled).select(F.col("id").alias("doc_id"), (F.col("id") % 3 != 0).cast("int").alias("label"))
    seen, fit = [], quality._View.fit
    monkeypatch.setattr(quality._View, "fit", lambda view, train: (seen.append(train.count()), fit(view, train)) and None)
    found = quality.score_quality(docs, labels, rounds=1)
    taught = labels.where("crc32(cast(cast(doc_id as string) as binary)) % 4 != 2").count()
    assert taught > 20_000 and seen == [taught, taught, taught + n - labelled, taught + n - labelled]
    assert found.where("keep != (doc_id % 3 != 0)").count() == 0


def test_quality_vectors_are_as_long_as_the_words_chosen(spark):
    """What a fit sends to the driver has a place for each word in use, not for each bucket of the hash."""
    word = F.when(F.col("id") % 2 == 0, F.array(F.lit(1), F.lit(2), F.lit(3))).otherwise(F.array(F.lit(2), F.lit(70_000)))
    for n, places in ((200, 4), (6, 1)):  # words of too few documents count for nothing
        view = quality._View("text", [])
        rows = spark.range(n).select((F.col("id") % 2).cast("double").alias("y"), word.alias("features"))
        view.fit(rows)
        assert view.model.numFeatures == places
        right = view.scored(rows, "p").where((F.col("p") > 0.5) == (F.col("y") == 1)).count()
        assert right == n or n == 6


def test_quality_writes_features_once(spark, monkeypatch):
    names = []
    for module in (quality, mixing):
        monkeypatch.setattr(module, "written", lambda df, name, real=module.written: (names.append(name), real(df, name))[1])
    labels = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, label int")
    quality.score_quality(make(spark, [(i, f"word {i}") for i in range(30)]), labels)
    assert names.count("features") == 1


def test_quality_drops_most_recognisable_insults(spark):
    """Of labelled toxic documents with an insult word at least 70 % go, of the good ones at most 5 %."""
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    insult = F.lower("text").rlike(r"(^|\s)(trash|pathetic|idiot|disgusting|worthless|stupid|clown|loser|scum|moron)(\s|$)")
    marks = labels.join(docs.select("doc_id", insult.alias("insult")), "doc_id")
    kind = F.when((F.col("toxic") == 1) & F.col("insult"), "insult").when((F.col("toxic") != 1) & (F.col("quality") == 1), "good")
    found = QUERIES["op3_quality_classifier"](spark, folder).join(marks, "doc_id")
    kept = {r.kind: r.kept for r in found.groupBy(kind.alias("kind")).agg(F.avg(F.col("keep").cast("int")).alias("kept")).collect()}
    print("kept", kept)
    assert kept["insult"] <= 0.3 and kept["good"] >= 0.95
