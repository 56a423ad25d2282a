"""PartEnum join, token alignment and conversation repair against brute force."""

import hashlib
import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from textmill.llm import conversation_repair as cr
from textmill.llm import partenum_join as pj
from textmill.llm import token_alignment as ta
from textmill.llm.lsh_forest import shingles
from textmill.llm.queries import vocabulary

SCHEMA = "doc_id bigint, text string"
CLASHING = "doc_id bigint, text string, row string, node string, key string, root string, pairs string, part string, n string, digest string"

# ---- 11 similarity join -------------------------------------------------------------------------


def word_sets(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def joined(rows, similar=90):
    """(id, set size, component) of every row by looking at all pairs."""
    sets = [word_sets(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= similar * (len(sets[i]) + len(sets[j]) - both):
            parent[find(i)] = find(j)
    members = defaultdict(list)
    for i, (own, _) in enumerate(rows):
        members[find(i)].append(own)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in members.items()}
    return sorted(((own, len(sets[i]), least[find(i)]) for i, (own, _) in enumerate(rows)), key=str)


def copies(seed, n=25):
    """Texts of many sizes with copies in which some words differ: links on both sides of the bound."""
    random = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        words = [f"w{x}" for x in random.integers(0, 3000, int(random.choice([2, 9, 12, 13, 20, 40, 90, 200, 420])))]
        rows.append(" ".join(words))
        for _ in range(int(random.integers(0, 6))):
            own = list(words)
            for _ in range(int(random.integers(0, 1 + len(own) // 25))):
                own[int(random.integers(len(own)))] = f"y{random.integers(10**6)}"
            if random.random() < 0.4:
                own = own[: len(own) - int(random.integers(0, 1 + len(own) // 12))]
            rows.append(" ".join(own))
    order = random.permutation(len(rows))
    table = [(int(i), rows[k]) for i, k in enumerate(order)]
    first = table[0][1]
    table += [(500, None), (501, ""), (502, " \t\n"), (503, "one"), (504, "ONE"), (505, first.upper()), (505, first.upper()),
              (None, first), (None, "a text without an id and without a copy"), (506, " ".join(f"v{i % 4001}" for i in range(30_000)))]
    return table


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", [0, 1])
def test_join_equals_all_pairs(spark, seed):
    rows = copies(seed)
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    expected = joined(rows)
    assert collected(pj.join(table)) == expected
    assert len({c for _, _, c in expected}) < len(rows) - 20


def test_join_of_blocks(spark, monkeypatch):
    """Large groups in portions and tiles: a chain and a star of copies of one text."""
    monkeypatch.setattr(pj, "NEAR", 4)
    monkeypatch.setattr(pj, "BLOCK", 4)
    monkeypatch.setattr(pj, "EARLY", 2)
    random = np.random.default_rng(5)
    words = [f"w{i}" for i in range(120)]
    rows, own = [], list(words)
    for i in range(30):
        rows.append((i, " ".join(own)))
        own[int(random.integers(len(own)))] = f"c{i}"
    for i in range(30, 60):
        star = [f"s{x}" for x in range(80)]
        for _ in range(int(random.integers(0, 3))):
            star[int(random.integers(80))] = f"z{random.integers(10**6)}"
        rows.append((i, " ".join(star)))
    assert collected(pj.join(spark.createDataFrame(rows, SCHEMA).repartition(3))) == joined(rows)


@pytest.mark.parametrize("similar", [60, 80, 90, 95])
def test_sets_at_the_bound_share_a_signature(similar):
    random = np.random.default_rng(similar)
    bands = pj.Bands(similar)
    for size in [*range(1, 60), 100, 333, 1000]:
        hashes = random.integers(0, 2**64, 2 * size + 2, dtype=np.uint64)
        for gone in range(size + 1):
            # ``gone`` shingles fewer, and as many others as the bound allows
            most = (100 * (size - gone) - similar * size) // similar
            if most < 0:
                break
            other = np.sort(np.concatenate([hashes[gone:size], hashes[size : size + most]]))
            one = np.sort(hashes[:size])
            if gone == most == 0:
                continue
            keys = [np.concatenate(pj.signatures(x, bands)) for x in (one, other)]
            assert np.intersect1d(*keys).size, (size, gone, most)
            apart = (pj.cell_bytes(one) != pj.cell_bytes(other)).sum()
            assert apart <= bands.differences(len(one) + len(other))


def test_join_of_odd_tables(spark):
    assert pj.join(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, "a b c d e f", *"rstuvwxy"), (2, "A b c d e f", *[None] * 8), (None, None, *"rstuvwxy")]
    found = collected(pj.join(spark.createDataFrame(rows, CLASHING)))
    assert found == sorted([(1, 4, 1), (2, 4, 1), (None, 0, None)], key=str)


# ---- 12 alignment -------------------------------------------------------------------------------

A_PATH, B_PATH = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def whole():
    """Tokens of whole texts, with no cuts and no caches."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    a.encode_special_tokens = True
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    byte_of = {chr(x): x for x in visible} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in visible)}

    def encode(text):
        if not text:
            return None
        sides = []
        first = a.encode(" " + text, add_special_tokens=False)
        sides.append([(i, bytes(byte_of[c] for c in t)) for i, t in zip(first.ids, first.tokens)])
        ids = b.encode(text)
        pieces = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids, b.id_to_piece(ids))]
        sides.append(list(zip(ids, pieces)))
        data = (" " + text).encode()
        if any(b"".join(t for _, t in side) != data for side in sides):
            return None
        return [[(i, e) for (i, _), e in zip(s, np.cumsum([len(t) for _, t in s]).tolist())] for s in sides]

    return encode


def groups_of(tokens):
    ends = sorted({e for _, e in tokens[0]} & {e for _, e in tokens[1]})
    at, groups = 0, []
    for end in ends:
        groups.append(tuple([i for i, e in side if at < e <= end] for side in tokens))
        at = end
    return groups


def aligned(rows, encode):
    grouped = [(own, groups_of(t) if (t := encode(text)) else []) for own, text in rows]
    held = Counter()
    for _, groups in grouped:
        held.update({(x, y) for a, b in groups for x in a for y in b})
    most = Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for own, groups in grouped:
        links = [(x, y) for a, b in groups for x in a for y in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            own, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
            sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=str)


def texts(seed=0):
    random = np.random.default_rng(seed)
    words = ["the", "Être", "naïve", "日本語", "x86_64", "don't", "😀", "antidisestablishment", "foo.bar", "1,234", "<|endoftext|>", "</s>", "<0x0A>", "ﬁ", "́e"]
    gaps = [" ", " ", " ", "  ", "\n", "\n\n", "\t", " ", " \n ", "　", "\x1c", ""]
    rows = [(i, "".join(str(random.choice(words)) + str(random.choice(gaps)) for _ in range(int(random.integers(1, 60))))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, " "), (103, "\n"), (104, "a▁b of"), (105, "▁"), (106, " lead"), (107, "trail "), (None, "no id"),
             (108, "\x00nul"), (3, rows[3][1]), (3, rows[3][1]), (109, "漢字かな" * 300), (110, "word " * 2500), (111, "x" * 3000)]
    return rows


def test_alignment_equals_whole_texts(spark, whole):
    rows = texts()
    found, counts = ta.align(spark.createDataFrame(rows, SCHEMA).repartition(3), A_PATH, B_PATH)
    expected = aligned(rows, whole)
    assert collected(found) == expected
    assert sum(r[1] == 0 for r in expected) >= 4
    assert counts.filter("best").count() > 20


def test_alignment_of_ranges(spark, whole):
    """Every text in ranges of a few characters, most pairs outside the broadcast head."""
    rows = texts(1)
    found, _ = ta.align(spark.createDataFrame(rows, SCHEMA).repartition(3), A_PATH, B_PATH, size=29, long=40, head=20)
    assert collected(found) == aligned(rows, whole)


def test_fragments_are_a_monoid():
    tokenizers = ta.Tokenizers(A_PATH, B_PATH)
    ids, ends = tokenizers.tokens(" " + "".join(t or "" for _, t in texts(2)[:12]))
    length = int(ends[0][-1])
    random = np.random.default_rng(0)
    expected = ta.Fragment.of(ids, ends, tokenizers).finished(tokenizers)
    for _ in range(30):
        borders = sorted({0, length, *random.integers(1, length, 9).tolist()})
        parts = []
        for begin, end in zip(borders, borders[1:]):
            inside = [(e > begin) & (e <= end) for e in ends]
            parts.append(ta.Fragment.of(*(tuple(x[m] for x, m in zip(xs, inside)) for xs in (ids, ends)), tokenizers))
        while len(parts) > 1:  # any bracketing
            i = int(random.integers(len(parts) - 1))
            parts[i : i + 2] = [parts[i].plus(parts[i + 1], tokenizers)]
        made = parts[0].finished(tokenizers)
        assert ";".join(made.groups) == ";".join(expected.groups) and (made.numbers == expected.numbers).all()
        assert all((x == y).all() for x, y in zip(made.pairs, expected.pairs))


def test_large_groups_are_counted(monkeypatch, whole):
    rows = texts(3)
    tokenizers = ta.Tokenizers(A_PATH, B_PATH)
    one = ta.aligned([t for _, t in rows], tokenizers)
    monkeypatch.setattr(ta, "LISTED", 1)
    two = ta.aligned([t for _, t in rows], tokenizers)
    assert all((x is None) == (y is None) and (x is None or all((p == q).all() for p, q in zip(x[2:], y[2:]))) for x, y in zip(one, two))


def test_alignment_of_odd_tables(spark):
    assert ta.align(spark.createDataFrame([], SCHEMA), A_PATH, B_PATH)[0].collect() == []
    rows = [(1, "plain words", *"rstuvwxy"), (1, None, *[None] * 8)]
    found, _ = ta.align(spark.createDataFrame(rows, CLASHING), A_PATH, B_PATH)
    assert sorted((r.doc_id, r.n_groups, r.groups_sha256 == "") for r in found.collect()) == [(1, 0, True), (1, 2, False)]


# ---- 13 conversations ---------------------------------------------------------------------------

TURNS = "conv_id bigint, turn bigint, role string, text string"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(rows, faults):
    """(cost, letters, repaired lines) by a table over (row, state)."""
    start = {0: (0, "", ())}

    def inserted(states):
        todo, best = list(states), dict(states)
        while todo:
            i = todo.pop()
            cost, letters, lines = best[i]
            j = 3 if i == 2 else 2
            new = (cost + 3, letters + "I", lines + (("user" if j == 2 else "assistant") + ":",))
            if j not in best or new[:2] < best[j][:2]:
                best[j] = new
                todo.append(j)
        return best

    states = start
    for (_, _, role, text), fault in zip(rows, faults):
        after = {}

        def offer(j, value):
            if j not in after or value[:2] < after[j][:2]:
                after[j] = value

        for i, (cost, letters, lines) in inserted(states).items():
            offer(i, (cost + 4, letters + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 * (fault == "truncated")
            j = 3 if i == 2 else 2
            offer(j, (cost + 3 + more, letters + "R", lines + (("user:" if j == 2 else "assistant:") + text,)))
            keeps = {"u": 2 if i != 2 else None, "a": 3 if i == 2 else None, "s": 1 if i == 0 else None}.get(role[:1])
            if keeps is not None:
                offer(keeps, (cost + more, letters + "K", lines + (f"{role}:{text}",)))
        states = after
    return min((v for k, v in inserted(states).items() if k in (0, 3)), key=lambda v: v[:2])


def audited(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]]
    for row in damaged(rows):
        groups[row[0]].append(row)
    out = []
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).digest()))
        faults, seen = [], set()
        for _, _, role, text in own:
            body = text.rstrip(" \t\n\r\x0b\x0c")
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        known = [r[1] for r in own if r[1] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(p[2][:1] + q[2][:1] not in ("su", "ua", "au") for p, q in zip(own, own[1:]))
        cost, letters, lines = cheapest(own, faults)
        count = Counter(faults)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, letters, digest))
    return sorted(out, key=str)


def turns(seed=0, conversations=60):
    random = np.random.default_rng(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "agent", "supervisor"]
    bodies = ["Yes.", "no", "What?", "", " \n", None, "Same. ", "cut off", "Fine!\t", "é.", "…"]
    rows = []
    for conv in range(conversations):
        for turn in range(int(random.integers(0, 14))):
            role = ["user", "assistant"][turn % 2] if random.random() < 0.6 else roles[int(random.integers(len(roles)))]
            text = f"Turn {turn}." if random.random() < 0.5 else bodies[int(random.integers(len(bodies)))]
            number = None if random.random() < 0.1 else turn + int(random.integers(0, 2)) * 3
            rows.append((conv, number, role, text))
    rows += [(None, 0, "user", "Without an id."), (None, None, None, None), (-1, None, "user", "One?"), rows[0], rows[0]]
    rows += [(999, int(t), "user" if t % 3 else "assistant", f"Long {t % 50}.") for t in range(700)]
    return rows


def test_repair_equals_a_plain_table(spark):
    rows = turns()
    table = spark.createDataFrame(rows, TURNS).repartition(3)
    assert collected(cr.audit(table)) == audited(rows)


def test_repair_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(cr, "FAN", 3)
    rows = turns(1, 30)
    table = spark.createDataFrame(rows, TURNS).repartition(3)
    assert collected(cr.audit(table, block=5, rounds=2, rules=3)) == audited(rows)


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hello."), (1, 1, "user", "Again?"), (1, 2, "assistant", "no end"), (1, 3, "assistant", ""), (2, 0, "tool", "x.")]
    found = cr.Repair(spark.createDataFrame(rows, TURNS)).repaired().orderBy("key", "position").collect()
    assert [tuple(r) for r in found if r.key == "=1"] == [
        ("=1", 0, "K", "user", "Hello."), ("=1", 1, "I", "assistant", ""), ("=1", 2, "K", "user", "Again?"), ("=1", 3, "K", "assistant", "no end"),
    ]
    audits = {r.key: (r.cost, r.audit) for r in cr.Repair(spark.createDataFrame(rows, TURNS)).audits.collect()}
    expected = {}
    for conv in (1, 2):
        own = [r for r in rows if r[0] == conv]
        faults = {1: ["", "", "truncated", "blank"], 2: [""]}[conv]
        expected[f"={conv}"] = cheapest(own, faults)[:2]
    assert audits == expected
    assert not any(r.key == "=2" for r in found)


def test_grammar_changes_nothing():
    random = np.random.default_rng(2)
    rules = [(cr.sign(1, 0) + cr.sign(2, 0), chr(0x200)), (chr(0x200) * 2, chr(0x201)), (chr(0x201) + cr.sign(2, 3), chr(0x202))]
    plain, known = cr.summaries_of([]), cr.summaries_of(rules)
    for _ in range(200):
        signs = "".join(cr.sign(*random.choice([(1, 0), (2, 0), (1, 0), (2, 0), (2, 3), (0, 0), (3, 1)])) for _ in range(int(random.integers(1, 40))))
        one, two = cr.evaluate(signs, [], plain), cr.evaluate(signs, rules, known)
        assert one.best() == two.best() and one.numbers == two.numbers
        assert [[c and (c[0], str(c[1])) for c in row] for row in one.matrix] == [[c and (c[0], str(c[1])) for c in row] for row in two.matrix]


def test_repair_of_odd_tables(spark):
    assert cr.audit(spark.createDataFrame([], TURNS)).collect() == []
    odd = TURNS + ", key string, part string, signs string, md5 string, costs string, audit string, letters string"
    rows = [(5, 1, "user", "Hello.", *"abcdefg"), (5, 2, "assistant", "Good day.", *[None] * 7)]
    assert collected(cr.audit(spark.createDataFrame(rows, odd))) == audited([r[:4] for r in rows])
