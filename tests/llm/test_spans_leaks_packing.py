"""Shared spans and leaks against brute force, packing invariants, the curve, rolling hashes."""

import random
import re
import unicodedata

import numpy as np
import pytest

from sessionloom.llm import leaks, packing, pairs, rolling, shared_spans


def test_window_hashes():
    points, _ = rolling.code_points(["abcabcabd", "xabc"])
    for size in (1, 2, 3, 5, 7):
        h = rolling.window_hashes(points, size)
        text = "abcabcabdxabc"
        by = {}
        for k in range(len(h)):
            by.setdefault(text[k : k + size], set()).add(int(h[k]))
        assert len(h) == len(text) - size + 1 and all(len(v) == 1 for v in by.values()) and len({next(iter(v)) for v in by.values()}) == len(by)
    assert len(rolling.window_hashes(points[:2], 3)) == 0


@pytest.mark.parametrize("width", [1, 2, 5, 8])
def test_winnowing_keeps_one_in_every_neighbourhood(width):
    h = np.random.default_rng(width).integers(0, 9, 60).astype(np.uint64)
    kept = set(rolling.winnowed(h, width).tolist())
    for k in range(len(h) - width + 1):
        assert any(k + j in kept and h[k + j] == h[k : k + width].min() for j in range(width))


def brute_pairs(docs, least):
    windows = {}
    for d, t in docs:
        for k in range(len(t or "") - least + 1):
            windows.setdefault(t[k : k + least], set()).add(d)
    return {(a, b) for ds in windows.values() for a in ds for b in ds if a < b}


@pytest.mark.parametrize(("kinds", "chars"), [(1, 10**6), (4, 300), (512, 10**6)])
def test_shared_spans_match_brute_force(spark, kinds, chars):
    rnd = random.Random(7)
    noise = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage, short = noise(90), noise(35)
    docs = [(1, noise(50) + passage + noise(20)), (2, passage[10:75] + noise(30)), (3, noise(9) + passage[60:] + noise(60)), (4, passage), (5, passage), (6, None), (7, ""), (8, noise(200)), (9, passage[:40] + noise(5) + passage[40:]), (10, "é" + passage[:45])]
    docs += [(20 + k, noise(20) + short + noise(20)) for k in range(12)] + [(40, noise(4) * 30), (41, "a" * 300), (42, "a" * 200), (43, passage[20:66] * 3)]
    df = spark.createDataFrame([(d, t, d) for d, t in docs] + [(4, passage, 4)], "doc_id long, text string, seed long").select("doc_id", "text", "seed")
    got = {tuple(r) for r in shared_spans.sharing_pairs(df, least=40, seed=16, kinds=kinds, chars=chars).collect()}
    assert got == brute_pairs(docs, 40)
    amount = {r["doc_id"]: r["shared_chars"] for r in shared_spans.shared_amount(df, least=40, seed=16, kinds=kinds, chars=chars).collect()}
    assert set(amount) == {d for p in got for d in p}
    for d, t in docs:
        if d in amount:
            others = [x for o, x in docs if o != d and x]
            covered = set()
            for k in range(len(t) - 39):
                if any(t[k : k + 40] in o for o in others):
                    covered.update(range(k, k + 40))
            assert amount[d] == len(covered), d


def test_factors_match_brute_force():
    rnd = random.Random(11)
    for trial in range(60):
        letters = "ab" if trial % 2 else "abcdefgh"
        noise = lambda n: "".join(rnd.choice(letters) for _ in range(n))  # noqa: B023, E731
        shared = [noise(rnd.randint(10, 60)) for _ in range(3)]
        blocks = [[noise(rnd.randint(0, 9)) + "".join(rnd.choice(shared)[rnd.randint(0, 5) :] for _ in range(rnd.randint(1, 3))) + noise(rnd.randint(0, 9)) for _ in range(rnd.randint(1, 2))] for _ in range(rnd.randint(2, 6))]
        voices, least = [rnd.choice([1, 1, 2]) for _ in blocks], rnd.choice([12, 13, 20])
        ref = shared_spans.Reference(voices, blocks, least)
        found, covered = set(), [set() for _ in blocks]
        for k in range(len(blocks)):
            for other, at, there, n in ref.factored(k):
                (part, a), (q, b) = ref.part(at), ref.part(there)
                assert n >= least and blocks[k][part][a : a + n] == blocks[other][q][b : b + n] and voices[k] == voices[other]
                found.add((k, other))
                covered[k].update((part, a + j) for j in range(n))
        grams = [{t[j : j + least] for t in texts for j in range(len(t) - least + 1)} for texts in blocks]
        assert found == {(x, y) for x in range(len(blocks)) for y in range(len(blocks)) if x != y and voices[x] == voices[y] and grams[x] & grams[y]}
        for k, texts in enumerate(blocks):
            others = set().union(*(g for y, g in enumerate(grams) if y != k and voices[y] == voices[k]))
            assert covered[k] == {(p, j + i) for p, t in enumerate(texts) for j in range(len(t) - least + 1) if t[j : j + least] in others for i in range(least)}


def test_pairs_within_large_sets(spark):
    df = spark.createDataFrame([("x", k, 20) for k in range(20)] + [("y", 1, 1)], "s string, m int, n long")
    assert {tuple(r) for r in pairs.pairs_within(df, "s", "m", part=3).collect()} == {(a, b) for a in range(20) for b in range(a + 1, 20)}


def test_no_documents_no_pairs(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert shared_spans.sharing_pairs(df).count() == 0 and shared_spans.shared_amount(df).count() == 0


def words(t):
    return re.findall(r"[^\W_]+", "".join(c for c in unicodedata.normalize("NFD", t.lower()) if not unicodedata.combining(c)))


def test_leaks_match_brute_force(spark):
    rnd = random.Random(4)
    vocab = ["l’àvia", "cotxe", "Riu", "verd", "o", "a", "muntanya", "paral·lel", "1984", "ÇA", "és", "sol", "lluna", "mar", "vent"]
    say = lambda n, sep=" ": sep.join(rnd.choice(vocab) for _ in range(n))
    items = [(k, say(rnd.randint(10, 40))) for k in range(12)] + [(50, "a o a o a o a o a o a o a"), (51, None), (52, "massa curt"), (53, "")]
    docs = [(100 + k, say(rnd.randint(0, 60))) for k in range(30)] + [(1, None), (2, ""), (3, items[0][1].upper().replace(" ", ", ")), (4, "x" + items[1][1]), (5, items[2][1][8:]), (6, say(5) + "\n" + "  ".join(items[3][1].split()[2:]) + "z"), (7, "o a o a o a o a o a o a o a o")]
    docs += [(8, " ".join(words(items[4][1])[:13])), (9, " ".join(words(items[4][1])[:12])), (10, (items[5][1] + " ") * 400)]
    want = set()
    for i, it in items:
        grams = {tuple(w[k : k + 13]) for w in [words(it or "")] for k in range(len(w) - 12)}
        for d, t in docs:
            w = words(t or "")
            if any(tuple(w[k : k + 13]) in grams for k in range(len(w) - 12)):
                want.add((i, d))
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, item_id string")
    it = spark.createDataFrame(items + items[:2], "item_id long, text string")
    for block in (leaks.BLOCK_CHARS, 200):
        for edits in (0, 1):
            got = {(r["item_id"], r["doc_id"]) for r in leaks.leaks(df.drop("item_id"), it, edits=edits, block_chars=block).where("edits = 0").collect()}
            assert got == want, (block, edits)
    assert leaks.leaks(df.limit(0), it).count() == 0 and leaks.leaks(df, it.limit(0)).count() == 0


def fewest_edits(passage, text):
    """Edits of ``passage`` anywhere in ``text``, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(passage, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != c), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_leaks_with_edits_match_brute_force():
    rnd = random.Random(8)
    vocab = ["avia", "cotxe", "riu", "verd", "o", "a", "muntanya", "parallel", "1984", "es", "sol", "lluna", "mar", "vent"]
    say = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))

    def noisy(t, n):
        for _ in range(n):
            p = rnd.randrange(len(t))
            t = t[:p] + rnd.choice(["", "x", " ", t[p] + "y"]) + t[p + rnd.choice([0, 1]) :]
        return t

    words_n, items, docs = 6, [say(rnd.choice([6, 7, 9, 12])) for _ in range(40)] + ["a o a o a o", "o a o a o a o a"], []
    for k, item in enumerate(items):
        w = item.split()
        at = rnd.randint(0, len(w) - words_n)
        docs.append(" ".join(noisy(f"{say(rnd.randint(0, 5))} {noisy(' '.join(w[at : at + words_n]), k % 5)} {say(rnd.randint(0, 5))}", 0).split()))
    for edits in (1, 2, 3):
        index = leaks.build(list(range(len(items))), items, words_n, edits)
        assert all((b[b > 0] >= 1).all() for _, b, _, _ in index.groups) and sum(int((b > 0).sum()) for _, b, _, _ in index.groups) == len(items)
        points, starts = leaks.folded(docs)
        got = leaks.find(index, points, starts, words_n, edits)
        want = {}
        for d, text in enumerate(docs):
            for i, item in enumerate(items):
                w = item.split()
                n = min(fewest_edits(f" {' '.join(w[k : k + words_n])} ", f" {text} ") for k in range(len(w) - words_n + 1))
                if n <= edits:
                    want[d, i] = n
        assert got == want, edits


def test_leaks_with_edits(spark):
    item = "una frase prou llarga de prova que algú ha copiat amb una falta petita dins del text"
    docs = spark.createDataFrame([(1, "abans " + item.replace("copiat", "copiar") + " despres"), (2, item.replace("prova", "xxxxx").replace("amb", "yyy").replace("petita", "zzzzzz")), (3, item)], "doc_id long, text string")
    it = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert {r["doc_id"] for r in leaks.leaks(docs, it, edits=0).collect()} == {3}
    assert {(r["doc_id"], r["edits"]) for r in leaks.leaks(docs, it, words=16, edits=1).collect()} == {(1, 1), (3, 0)}


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_neighbours(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
    keys = packing.hilbert(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    assert np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1).max() == 1


def test_packing_keeps_every_token_once(spark):
    rnd = random.Random(2)
    say = lambda n: " ".join(rnd.choice(["casa", "mar", "muntanya", "parlament", "és", "1984"]) for _ in range(n))
    docs = [(k, say(rnd.choice([0, 1, 5, 30, 200, 900]))) for k in range(300)] + [(1000, None), (1001, ""), (1002, "igual " * 40), (1003, "igual " * 40), (None, "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    df = df.unionByName(df.where("doc_id < 3"))
    encoding = packing.tokenizer()
    size = {d: len(encoding.encode_ordinary(t)) for d, t in docs if d is not None and t is not None}
    capacities = [("s", 128), ("m", 512)]
    got = packing.assigned(spark, df, capacities).collect()
    for name, room in capacities:
        used, parts = {}, {}
        for r in (r for r in got if r["capacity_name"] == name):
            used[r["container_id"]] = used.get(r["container_id"], 0) + r["token_to"] - r["token_from"]
            parts.setdefault(r["doc_id"], []).append((r["part_no"], r["token_from"], r["token_to"]))
        assert set(parts) == set(size) and max(used.values()) <= room
        for d, p in parts.items():
            p.sort()
            assert p[0][1] == 0 and p[-1][2] == size[d] and all(a[2] == b[1] for a, b in zip(p, p[1:])) and (len(p) == 1 or size[d] > room)
        assert sum(used.values()) / (len(used) * room) > 0.9
    fill = packing.filled(packing.assigned(spark, df, capacities), capacities)
    assert fill.where("used_tokens > capacity_tokens").count() == 0
    assert packing.assigned(spark, df.limit(0), capacities).count() == 0


def test_best_fit_takes_the_fullest_container():
    p = packing.Packer(10, 0)
    assert [(c, d) for c, d, *_ in p.chunk([(1, 6), (2, 7), (3, 3), (4, 4), (5, 23)])] == [(0, 5), (1, 5), (2, 2), (3, 1), (3, 4), (2, 3), (4, 5)]
