"""Line rules, filter audit and conversation trie on small tables with every odd case, against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import pytest

from tidegauge.llm import conversation_trie, filter_audit, line_rules
from tidegauge.llm.tree_contraction import subtree_totals

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, kept boolean, host string, h long, mask int, lines string, part string"


def words(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdefgh", k=rng.randint(1, 3))) for _ in range(n)]


def make(spark, rows):
    """(doc_id, text, lang, source) rows as a table whose other columns clash with names that the operators use."""
    return spark.createDataFrame([(*r, None, "x", 1, 3, "y", "z") for r in rows], SCHEMA)


def collected(df):
    return [tuple(r) for r in df.collect()]


# Line rules


def measures(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def norm(line):
    return " ".join(WORD.findall(re.sub("[0-9]+", "0", line.lower())))


def judged(rows, share, least):
    hosts, held = defaultdict(set), defaultdict(set)
    for _, text, _, source in rows:
        hosts[source or ""].add(text or "")
        for line in (text or "").split("\n"):
            held[source or "", norm(line)].add(text or "")
    out = []
    for i, text, _, source in rows:
        m = measures(text)
        gone = 0
        for line in (text or "").split("\n"):
            n = len(held[source or "", norm(line)])
            if norm(line) and n > least and n > share * len(hosts[source or ""]):
                gone += len(WORD.findall(line))
        failed = m[0] < 50 or 100 * m[4] > 50 * m[0]
        out.append((i, *m, failed, gone, not failed and m[0] - gone >= 50 and m[0] - gone >= 0.5 * m[0]))
    return out


@pytest.fixture(scope="module")
def pages():
    foot = "Copyright  2024 Example\tInc"
    rows = [(i, "\n".join([" ".join(words(70, i)), foot.upper() if i % 2 else foot.replace("2024", "1999"), "", "\x0b"]), "en", "a") for i in range(30)]
    rows += [(100 + i, "\n".join([" ".join(words(45, 900 + i)), foot, foot]), "en", "a") for i in range(5)]
    rows += [(200 + i, "\n".join([" ".join(words(60, 200 + i)), foot]), "en", "b") for i in range(3)]
    copy = "\n".join([" ".join(words(80, 777)), "a line of its own"])
    rows += [(300 + i, copy, "en", "a") for i in range(60)] + [(None, copy, None, None), (7, copy, "en", "a"), (7, copy, "en", "a")]
    rows += [(400, None, None, None), (401, "", "", ""), (402, " \n\t\x0b\x0c\r\n ", "en", "a"), (403, "one", "en", None), (404, "a b c", "en", "c")]
    rows += [(405, "a b c a b c", "en", "c"), (406, "x x x x x", "en", "c"), (407, " ".join(["x"] * 60), "en", "c"), (408, "<a>#$%&|* b\nb\nb\n  b", "en", "c")]
    rows += [(409, "É 😀 日本 語   z\n" * 30, "fr", "c"), (410, " ".join(words(40_000, 5)), "en", "c"), (411, "12 34\n56 78\n", "en", "c")]
    return rows


@pytest.mark.parametrize("bound", [0, 200_000])  # the frequent lines shuffled or broadcast
def test_line_rules(spark, pages, bound, monkeypatch):
    monkeypatch.setattr(line_rules, "BROADCAST_LINES", bound)
    found = line_rules.judge_lines(make(spark, pages), share=0.2, least=10)
    if not bound:
        monkeypatch.setattr(line_rules.removed_words, "__defaults__", (0,))
        found = line_rules.judge_lines(make(spark, pages), share=0.2, least=10)
    want = judged(pages, 0.2, 10)
    assert Counter(collected(found)) == Counter(want)
    assert any(r[-2] and r[-1] for r in want) and any(r[-2] and not r[6] and not r[-1] for r in want)


def test_frequent_lines_count_copies_once(spark, pages):
    measured = line_rules.document_measures(make(spark, pages), "doc_id", "text", "source")
    found = {(r["host"], r["n_documents"]) for r in line_rules.frequent_lines(measured, 0.2, 10).collect()}
    assert found == {("a", 35)}


def test_cleaned_documents(spark, pages):
    clean = line_rules.cleaned_documents(make(spark, pages), share=0.2, least=10)
    assert clean.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    verdict = judged(pages, 0.2, 10)
    want = Counter()
    for row, v in zip(pages, verdict, strict=True):
        if v[-1]:
            lines = row[1].split("\n")
            want[row[0], "\n".join(x for x in lines if not (row[3] == "a" and norm(x) == "copyright 0 example inc"))] += 1
    assert Counter((r["doc_id"], r["text"]) for r in clean.collect()) == want


def test_line_rules_without_documents(spark):
    none = make(spark, [])
    assert line_rules.judge_lines(none).count() == 0 and line_rules.cleaned_documents(none).count() == 0


# Filter audit


def mask_of(rows, row):
    i, text = row[0], row[1] or ""
    w = WORD.findall(text)
    earlier = i is not None and any(j is not None and j < i and (t or "") == text for j, t, *_ in rows)
    caps = sum("A" <= c <= "Z" for c in text)
    return [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * caps > 3 * len(text), any(c in "#$%&*|" for c in text), earlier]


def audited(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = defaultdict(list)
    for row in rows:
        parts[row[2] or ""].append((row[0], dict(zip("ABCDE", mask_of(rows, row), strict=True))))
    out = []
    for part, docs in parts.items():
        shapley, found = Counter(), []
        for order in permutations("ABCDE"):
            alive = docs
            for step, x in enumerate(order, 1):
                gone = [d for d in alive if d[1][x]]
                redundant = sum(d[1][x] for d in docs) - len(gone)
                only = sum(d[1][x] and sum(d[1].values()) == 1 for d in docs)
                alive = [d for d in alive if not d[1][x]]
                shapley[x] += len(gone)
                found.append([part, "".join(order), step, len(alive), len(gone), redundant, only, sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone)])
        out += [(*f, shapley[f[1][f[2] - 1]]) for f in found]
    return out


@pytest.fixture(scope="module")
def filtered():
    rng = random.Random(4)
    rows = []
    for i in range(60):
        text = " ".join(words(rng.choice([50, 250, 400]), rng.randint(0, 20)))
        text = text.upper() if rng.random() < 0.2 else text + rng.choice(["", "", " #1"])
        rows.append((i, text, rng.choice(["en", "de"]), "s"))
    rows += [(5, rows[5][1], "en", "s"), (5, rows[5][1], "en", "s"), (None, rows[5][1], "en", "s"), (None, None, None, None), (61, None, None, "s"), (62, "", "", "s")]
    rows += [(63, "x " * 300_000, "en", "s"), (1000, rows[0][1], "fr", "s"), (-4, rows[1][1], "fr", "s"), (64, "tab\x0bword É", "zz", "s")]
    labels = [(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(70)] + [(3, 1, 1), (3, None, None), (None, 1, 1), (5, 0, 0), (9999, 1, 1)]
    return rows, labels


LABELS = "doc_id long, quality int, toxic int, mask int"


def test_filter_audit(spark, filtered):
    rows, labels = filtered
    found = filter_audit.audit_filters(make(spark, rows), spark.createDataFrame([(*x, 1) for x in labels], LABELS))
    want = audited(rows, labels)
    assert len(want) == 600 * len({r[2] or "" for r in rows})
    assert Counter(collected(found)) == Counter(want)
    assert dict(found.dtypes)["step"] == "int" and set(dict(found.dtypes).values()) == {"string", "int", "bigint"}


def test_filter_audit_of_a_hot_text(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "'same text' as text", "cast(null as string) as lang")
    cells = filter_audit.document_cells(docs, spark.createDataFrame([], LABELS)).collect()
    assert {(r["part"], r["mask"], r["n"]) for r in cells if r["n"]} == {("", 1, 1), ("", 17, 19_999)}


def test_filter_audit_of_nothing(spark):
    none = spark.createDataFrame([], LABELS)
    assert filter_audit.audit_filters(make(spark, []), none).count() == 0
    with pytest.raises(ValueError):
        filter_audit.audit_orders(none.selectExpr("'' part", "mask", "1L n", "0L good", "0L toxic"), "ABCDEFG")


# Trees and conversations


def totals_by_hand(nodes):
    kids = defaultdict(list)
    for i, parent, *_ in nodes:
        kids[parent].append(i)
    own, out = {i: (a or 0, b or 0) for i, _, a, b in nodes}, {}
    order, stack = [], list(kids[None])
    while stack:
        x = stack.pop()
        order.append(x)
        stack += kids[x]
    for x in reversed(order):
        out[x] = tuple(own[x][k] + sum(out[c][k] for c in kids[x]) for k in (0, 1))
    return Counter((i, *t) for i, t in out.items())


def shapes():
    rng = random.Random(9)
    chain = [(i, i - 1 if i else None) for i in range(70)]
    star = [(i, 0 if i else None) for i in range(50)]
    bush = [(i, rng.randrange(max(0, i - 4), i) if i else None) for i in range(300)]
    comb = [(i, None if i == 0 else i - 1 if i < 40 else i - 40) for i in range(80)]
    two = [(i, None if i < 2 else i % 2 if i < 4 else i - 2) for i in range(30)]
    return {"chain": chain, "star": star, "bush": bush, "comb": comb, "two": two, "one": [(5, None)], "none": []}


@pytest.mark.parametrize("shape", shapes())
def test_subtree_totals(spark, shape):
    rng = random.Random(2)
    nodes = [(i, p, rng.choice([None, rng.randint(-5, 50)]), rng.randint(0, 9)) for i, p in shapes()[shape]]
    tree = spark.createDataFrame(nodes, "id long, parent long, a long, b int")
    for block in (3, 100_000):
        assert Counter(collected(subtree_totals(tree, ["a", "b"], block))) == totals_by_hand(nodes)


def rebuilt(rows):
    turns = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append((t is not None, t or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest(), (role, text)))
    own = {c: [x[-1] for x in sorted(v)] for c, v in turns.items()}
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    rest = lambda c: c - (abs(c) % 20) * (1 if c >= 0 else -1)
    return {c: own.get(rest(c), [])[: h[c]] + own[c][h[c] :] for c in own}


def trie_by_hand(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
        ends[tuple(convs[c])].append(c)
    kids = defaultdict(list)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) if kids[k] else 1
        mine = (len(members[k]) - 1) * len(WORD.findall(k[-1][1])) if k else 0
        saved[k] = mine + sum(saved[x] for x in kids[k])
    sha = lambda k: hashlib.sha256(",".join(map(str, ends[k])).encode()).hexdigest()
    return Counter((members[k][0], len(k), members[k[:-1]][0] if k else None, len(members[k]), len(kids[k]), leaves[k], saved[k], sha(k)) for k in members)


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(6)
    say = lambda: rng.choice(["hi there", "a b c", "", None, "x\x0by", "What now?"])
    rows = [(c, t, rng.choice(["user", "assistant", None]), say()) for c in range(130) for t in range(rng.randint(1, 6))]
    rows = [r for r in rows if not 40 <= r[0] < 43]  # their family has no first conversation
    rows += [(3, None, "user", "before all"), (3, 1, "user", "tie"), (3, 1, "user", "tie"), (3, 1, None, None), (None, 1, "user", "of none"), (-7, 0, "u", "below")]
    rows += [(200 + c, t, "user", f"shared {t}") for c in range(40) for t in range(3)]
    rows += [(500, t, "user", f"long {t % 7}") for t in range(90)] + [(501, 1, "user", "word " * 100_000)]
    return rows


TALKS = "conv_id long, turn long, role string, text string, depth int, parent string, words int"


def trie(spark, rows, build):
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], TALKS)
    return Counter(collected(conversation_trie.prefix_trie(*build(conversation_trie.ordered_turns(table)))))


@pytest.mark.parametrize("block", [8, 10_000])
def test_conversation_trie(spark, talks, block, monkeypatch):
    monkeypatch.setattr(conversation_trie, "BLOCK", block)
    if block == 8:
        monkeypatch.setattr(conversation_trie, "HOT_CHILDREN", 2)
        monkeypatch.setattr(conversation_trie, "CHUNK", 3)
    assert trie(spark, talks, conversation_trie.rebranched) == trie_by_hand(rebuilt(talks))


def test_trie_of_conversations_as_they_are(spark, talks):
    own = defaultdict(list)
    for c, t, role, text in sorted((r for r in talks if r[0] is not None and 200 <= r[0] <= 500), key=lambda r: r[:2]):
        own[c].append((role or "", text or ""))
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in talks if r[0] is not None and 200 <= r[0] <= 500], TALKS)
    assert Counter(collected(conversation_trie.shared_prefixes(table))) == trie_by_hand(own)


def test_trie_of_nothing(spark):
    assert not trie(spark, [], conversation_trie.rebranched)
    assert not trie(spark, [(None, 1, "user", "x")], conversation_trie.rebranched)


def test_trie_of_one_conversation_without_turns(spark):
    lone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    rows = [(lone, 0, "user", "gone")]
    assert trie(spark, rows, conversation_trie.rebranched) == trie_by_hand(rebuilt(rows))
