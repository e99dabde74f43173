"""Operators that SQL cannot express, against brute force or another library."""

import random

import numpy as np
import pytest

from kilnspark.llm import bpe, leakage, level, names, survivor

regex = pytest.importorskip("regex")


def test_bpe_equals_the_library():
    tokenizers = pytest.importorskip("tokenizers")
    path = f"{bpe.TOKENIZERS}/byte_bpe_50k.json"
    t = tokenizers.Tokenizer.from_file(path)
    t.encode_special_tokens = True
    rng = random.Random(5)
    texts = ["", " ", "a" * 3000, "ab" * 2000, "I'll  don't\n\n x<|endoftext|>y", "é漢字🎉" * 50, "\x00\x01", "kiln " * 4000] + ["".join(rng.choice("abe ß\n1.'ñ漢") for _ in range(rng.randint(0, 200))) for _ in range(200)]
    ids, sizes = bpe.Vocabulary.load(path).encode(texts, regex.compile(bpe.PATTERN))
    at = np.r_[0, np.cumsum(sizes)]
    for i, x in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == t.encode(x, add_special_tokens=False).ids


def test_choose_equals_brute_force():
    from itertools import combinations

    rng = random.Random(1)
    for _ in range(200):
        lacking = rng.randrange(1, 16)
        c = [(rng.randrange(16), i) for i in range(rng.randint(0, 6))]
        goal = 0
        for b, _ in c:
            goal |= b & lacking
        best = None
        for n in range(len(c) + 1):
            for pick in combinations(c, n):
                got = 0
                for b, _ in pick:
                    got |= b & lacking
                ranks = sorted(r for _, r in pick)
                if got == goal and (best is None or (n, sum(ranks), ranks) < best):
                    best = (n, sum(ranks), ranks)
        assert (len(found := survivor.choose(lacking, c)), sum(found), found) == best


def _plain_distance(a, b):
    d = {(i, j): i or j for i in range(len(a) + 1) for j in range(len(b) + 1) if not i or not j}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_near_equals_the_matrix():
    rng = random.Random(2)
    for _ in range(2000):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randint(0, 6))) for _ in range(2))
        for most in (1, 2):
            assert names.near(a, b, most) == (_plain_distance(a, b) <= most), (a, b)


def test_alignment():
    assert names.aligned(["cement", "industries"], ["industries", "cement"], 1) == 1
    assert names.aligned(["m", "rope"], ["rope", "michael"], 1) == pytest.approx(0.9)
    assert names.aligned(["cement"], ["kiln", "services"], 1) == 0


def test_read_name():
    same = ["Byzepygo Clinker Engineering AG", "Clinker Engineering Byzepygo", "Byzépygo Clinker Eng.", "BYZEPYGÖ-CLINKER ENGINEERS, A.G.".replace("Ö", "O"), "BCE (Byzepygo Clinker Engrg)", "The Byzepygo Clinker Eng. - Hujatryvol", "Byze pygo Clinker Engineering"]
    assert {(r[0], r[1].replace(" ", ""), r[2]) for r in map(names.read_name, same)} == {("clinker engineering", "byzepygo", "")}  # words stay as typed; all of them together are an index entry too
    assert names.read_name("Rivybrysti, Mike - Consultancy")[:3] == names.read_name("Dr. Michael Rivybrysti Consulting")[:3] == ("consulting", "rivybrysti", "michael")
    assert names.read_name("NRI Zasepepa (Nat. Res. Inst.)")[:2] == names.read_name("National Institute for Research Zasepepa")[:2]
    assert names.read_name("X, Uni of")[:2] == names.read_name("The University of X, Dept. of Civil Eng.")[:2] == ("university", "x")


def _passage(rng, n):
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def test_minhash_recall_against_brute_force():
    """All pieces of a sixth or more of an item are found as candidates, up to the chosen chance of a miss."""
    rng = random.Random(7)
    items = [(i, " ".join(_passage(rng, rng.randint(40, 120)))) for i in range(60)]
    index = leakage.build_index(items)
    h, parts, truth = leakage.Hasher(), [], set()
    for n in range(300):
        i, text = rng.choice(items)
        w = text.split()
        size = len(w) // 3 + 2
        at = rng.randrange(len(w) - size)
        doc = _passage(rng, rng.randint(0, 2000)) + w[at : at + size] + _passage(rng, rng.randint(0, 500))
        parts.append(h.shingles(h.words(leakage.words(" ".join(doc)))))
        truth.add((n, i))
    found = set(zip(*map(list, leakage.candidates(index, np.concatenate(parts), np.cumsum([len(p) for p in parts])))))
    assert len(truth & found) >= 0.99 * len(truth)


def test_shares_equal_counting():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 50, n).astype(np.uint64)) for n in (5, 20, 0, 30)]
    docs = [rng.integers(0, 50, n).astype(np.uint64) for n in (10, 40, 1)]
    sh, of = np.concatenate(docs), np.repeat(np.arange(3), [10, 40, 1])
    which, where = np.repeat(np.arange(4), 3), np.tile(np.arange(3), 4)
    got = leakage.shares(sets, which, where, sh, of)
    for g, i, n in zip(got, which, where):
        assert np.isnan(g) if not len(sets[i]) else g == np.isin(sets[i], docs[n]).mean()


def test_words_and_passages():
    assert leakage.words("At 4,515 m — 0.45 x!") == ["at", "4515", "m", "045", "x"] == leakage.words("AT 4 515 m 0 45 X")
    assert leakage.passage("One. Two.\nWhat next?") == "One. Two." and leakage.passage("One. Two. How many?") == "One. Two."


LEVELS = {1: "The dog ran to the mud. It was wet and fun. We dig the sand. Look at my shoe.", 2: "The company plans to buy trucks. Experts warn about dust from the yard. Neighbours say the road stayed dry.", 3: "Specimens were cured and the compressive strength was measured. The activation energy was estimated from calorimetry."}


def test_level_on_held_out_passages():
    rng = random.Random(3)
    rows = [(" ".join(rng.sample(t.split(". "), 2)) + ".", k) for k, t in LEVELS.items() for _ in range(20)]
    model = level.train(rows[::2])
    assert sum(model.level(t) == k for t, k in rows[1::2]) >= 0.95 * len(rows[1::2])
    assert model.level("") is None and model.level("123 456") is None
    run_on = " and ".join(s.strip(". ").lower() for s in LEVELS[1].split(". ")) + " and the company plans to buy trucks"
    assert model.level(run_on) == 1


def test_page_kinds_and_forms():
    from kilnspark.llm import pagebody as P

    assert P.shapes("Sponsored: save 8% on rope in Rope") == ("Sponsored|:%", "Sponsored :", "in Rope") and P.shapes("5 of 6.")[1] == "0 of"
    patterns = tuple(p for ps in P.FURNITURE.values() for p in ps)
    menu = {"Home", "Costs", "Shop", "News"}
    page = ["Home", "Costs", "Shop", "A title here", "Costs", "- ash, 4 %", "Mix | Age", "B5 | 3 d", "News | Shop | Home", "Share of ash in the binder: 4 %", "Share this article", "All rights to the ash passed to the quarry.", "Readers should subscribe to one rule: wait."]
    kinds = [P.first_kind(s, patterns)[0] for s in page]
    found = P.settle(kinds, [s in menu for s in page], [s[0] == "-" for s in page])
    assert [P.KINDS[k] for k in found] == ["menu", "menu", "menu", "prose", "heading", "list", "head", "table", "menu", "prose", "furniture", "prose", "prose"]
    assert P.first_kind("Share this nice article", ())[0] == P.PROSE
    assert [P.needle(p) for p in (r"\bcookies?\b.*(?:a|b)", r"(?:…|\.\.\.)\s*read more\b", r"full story \(members only\)$", r"\b\d+ min read$", r"a|b", r"withdraw (?:your )?consent")] == ["cookie", "read more", "members only", " min read", "", "withdraw "]
    for p in (p for ps in P.FURNITURE.values() for p in ps if p[0] != "^"):
        assert P.needle(p), p
    assert P.branches([P.HEADING, P.NOISE, P.LIST, P.LIST, P.PROSE], [True] * 4 + [False])[0] == [1, -2, 1, 1, 2]


def test_forms_learn_from_what_stands_beside_them():
    import numpy as np
    from kilnspark.llm import pagebody as P

    tree = P.Tree(0.0)
    assert tree.belief(np.array([P.PROSE]), np.array([[1, 2, 3]])) == 0.5  # nothing is known yet
    tree.learn(np.array([3, 1, 2]), np.array([90.0, 5.0, 90.0]), np.array([100.0, 100.0, 100.0]))
    low, high, new = tree.belief(np.full(3, P.PROSE), np.array([[1, 1, 1], [3, 3, 2], [7, 8, 9]]))
    assert low < 0.05 < 0.45 < new < 0.55 < high
    assert P.Tree(0.9).belief(np.array([P.NOISE, P.PROSE]), np.array([[1, 1, 1], [3, 3, 2]]))[0] < 0.01


def test_leaks_of_several_sizes(spark):
    """Items of four size classes, planted whole, in part and in two parts, with words changed, in short and long documents; and texts that only
    share a template, a name or less than a third with an item. Whether a document holds an item is known from how it was made."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(rng.randint(2, 4)))
    plain = [word() for _ in range(4000)]
    text = lambda n: [rng.choice(plain) for _ in range(n)]
    items = {i: text(n) for i, n in enumerate([24] * 12 + [50] * 12 + [110] * 12 + [260] * 6)}
    template = text(8)
    docs, true = [], set()

    def changed(ws):
        return [word() if n % 14 == 9 else w.upper() if n % 5 == 0 else w + "," * (n % 7 == 0) for n, w in enumerate(ws)]

    for i, ws in items.items():
        third = len(ws) * 2 // 5 + 1
        for kind in range(6):
            at = rng.randrange(len(ws) - third)
            half = third // 2 + 1
            held = {0: [ws], 1: [ws[at : at + third]], 2: [ws[:half], ws[-half:]], 3: [template], 4: [ws[:7]], 5: [ws]}[kind]
            around = text(rng.choice([5, 60, 900]))
            for piece in held:
                cut = rng.randrange(len(around))
                around = around[:cut] + (changed(piece) if kind != 0 else piece) + around[cut:]
            docs.append((len(docs), " ".join(around)))
            if kind in (0, 1, 2, 5):
                true.add((len(docs) - 1, i))
    d = spark.createDataFrame([*docs, (10_000, None), (10_001, ""), docs[0]], "doc_id long, text string").repartition(3)
    q = spark.createDataFrame([(i, " ".join(template + ws) + ". What is it?") for i, ws in items.items()] + [(99, None), (98, "two words")], "item_id long, text string")
    for block in (5000, 10):
        got = {(r.doc_id, r.item_id) for r in leakage.find_leaks(d, q, block=block).collect()}
        assert len(got & true) >= 0.98 * len(true) and got <= true, (len(true), len(got & true), sorted(got - true)[:5])
    assert leakage.find_leaks(d.limit(0), q).count() == 0 and leakage.find_leaks(d, q.limit(0)).count() == 0
