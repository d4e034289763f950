"""Name readings, their comparison, blocking and linking."""

import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sessionloom.llm import name_linking as L
from sessionloom.llm.name_filter import candidates
from sessionloom.llm.names import Reading, comparable, compare, is_chair, lcs, read

SAME = [
    ("Nasi Saltreús i Ribtreoll", "Ignasi Saltreús i Ribtreoll"), ("FC Dorlagaia", "Federació de Comerç de Dorlagaia"), ("Cbra. de Regants d’Ivozagaia Vell", "Cambra de Regants d’Ivozagaia Vell"),
    ("PEP Murvinell Vell", "Plataforma per l’Escola Pública de Murvinell Vell"), ("Ivoninell de la Serra, Cooperativa Agrícola", "Cooperativa Agrícola d’Ivoninell de la Serra"), ("Lola Ribbruó i Casqueró", "Maria Dolors Ribbruó i Casqueró"),
    ("El conseller de Salut (BALVINET I ARPELIGA, DELFÍ)", "Delfí  Balvinet y Arpeliga | GP Mixt"), ("Ricrad Palnetard i Borvinúús", "Ricard Palnetard i Borvinús"), ("Biel Verpelet i Codfoench", "Gabriel Verpelet i Codfoench"),
    ("Annieta Monfelard i Verrosell", "Anna Maria Monfelard i Verrosell"), ("Uri Caldelell i Casbruús", "Oriol Caldelell i Casbruús"),
]
PART = [("G. Verpelet i Codfoench", "Gabriel Verpelet i Codfoench"), ("Sr. Xirgueell i Verrosó", "Bernat Xirgueell i Verrosó"), ("Marta Mirpeló i M.", "Marta Mirpeló i Merbruanya"), ("Anna Maria Llapelard", "Anna Maria Llapelard i Tormunell"), ("Quim Castreiga", "Joaquim Castreiga i Ribgueó")]
DIFFERENT = [
    ("Remei Balvinet i Arpeliga", "Delfí Balvinet i Arpeliga"), ("Associació de Veïns de Dorlagaia", "Federació de Comerç de Dorlagaia"), ("Consell Esportiu de Pessasola", "Consell Esportiu de Pessasola Vell"), ("Xell Marmunet i Llafoús", "Vicenç Marmunet i Llafoús"),
    ("Isona Olinetard i Palmuniga", "Isona Porvinerç i Ribnetard"), ("Joana Pi i Mas", "Joan Vila i Roca"), ("AV Dorlagaia", "Federació de Comerç de Dorlagaia"),
]


@pytest.mark.parametrize(("a", "b"), SAME)
def test_same(a, b):
    links = [compare(read(a), read(b)), compare(read(b), read(a))] if read(a).core != read(b).core else []
    assert read(a).core == read(b).core or any(m and m.kind == "same" for m in links)


@pytest.mark.parametrize(("a", "b"), PART)
def test_part(a, b):
    assert compare(read(a), read(b)).kind == "part" and compare(read(b), read(a)) is None


@pytest.mark.parametrize(("a", "b"), DIFFERENT)
def test_different(a, b):
    assert compare(read(a), read(b)) is None and compare(read(b), read(a)) is None


def test_offices_have_no_reading():
    for n in ("mesa", "El president", "La vicepresidenta primera", "Diversos diputats", "El conseller d’Interior", "", "  ", "El secretari primer"):
        assert read(n) is None
    assert is_chair("LA PRESIDENTA DEL PARLAMENT:") and not is_chair("El secretari primer") and not is_chair("El president de la Generalitat")
    assert read("L. Salmunench i Bredraet").tokens == ("l", "salmunench", "bredraet")


@settings(max_examples=80, deadline=None)
@given(st.text("abc", max_size=9), st.text("abc", max_size=9))
def test_lcs_against_the_table(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    assert lcs(a, b) == t[-1][-1]


def test_blocks_hold_all_pairs_that_differ_in_one_token(spark):
    """Also for suffixes that far more readings share than ``common``."""
    rnd = random.Random(1)
    names = [(f"{a}", f"{b}anya", f"{c}ench") for a in "pqrs" for b in ("cal", "bal", "tor", "mir") for c in ("sol", "mas", "vil")]
    rnd.shuffle(names)
    df = spark.createDataFrame([(k, list(n)) for k, n in enumerate(names)], "id long, tokens array<string>")
    keys = {}
    for r in L.blocks(df, 4, 4).collect():
        keys.setdefault(r["key"], set()).add(r["id"])
    for i, a in enumerate(names):
        for j in range(i):
            if sum(x != y for x, y in zip(a, names[j], strict=True)) == 1:
                assert any({i, j} <= ids for ids in keys.values())


def test_blocks_of_all_tokens_but_one_drop_no_pair(spark):
    """The names above with a bound that four readings exceed, and a typo in both ends of the differing token."""
    names = [(f"{a}", f"{b}anya", f"{c}ench") for a in "pqrs" for b in ("cal", "bal", "tor", "mir") for c in ("sol", "mas", "vil")]
    names += [(g, "xi", "yo") for g in ("pepe", "josep", "marcus", "parcuz", "anna", "rita")]
    keys = {}
    for r in L.blocks(spark.createDataFrame([(k, list(n)) for k, n in enumerate(names)], "id long, tokens array<string>"), 4, 3).collect():
        keys.setdefault(r["key"], set()).add(r["id"])
    for i, a in enumerate(names):
        for j in range(i):
            if sum(x != y for x, y in zip(a, names[j], strict=True)) == 1:
                assert any({i, j} <= ids for ids in keys.values())


def found_and_brute_force(spark, names, common):
    """Links of the operator, and of all pairs of readings that share the last four letters of a token."""
    readings = [read(n) for n in names]
    tokens = [(k, list(r.tokens), r.titled, r.organisation) for k, r in enumerate(readings)]
    df = spark.createDataFrame(tokens, "id long, tokens array<string>, titled boolean, organisation boolean")
    found = {(r["src"], r["dst"], r["kind"]) for r in L.edges(df, 4, common).collect()}
    all_pairs = {(r["src"], r["dst"], r["kind"]) for r in L.edges(df, 4, 10**6).collect()}
    ends = [{t[-4:] for t in r.tokens if len(t) >= 4} for r in readings]
    count = Counter(t for r in readings for t in set(r.tokens))

    def rare(p, q):
        low, high = sorted((count[p], count[q]))
        return low <= 1 or low <= 3 and 2 * low <= high or 10 * low <= high

    want = set()
    for i, a in enumerate(readings):
        for j in range(i):
            if ends[i] & ends[j]:
                x, y = compare(a, readings[j], rare), compare(readings[j], a, rare)
                if "same" in (x and x.kind, y and y.kind):
                    want |= {(i, j, "same"), (j, i, "same")}
                elif x or y:
                    want.add((i, j, "part") if x else (j, i, "part"))
    return found, all_pairs, want


def test_a_hot_token_drops_no_pair(spark):
    """'Xavier Borlamó' and 'Xavier Borlmó i Garlamús' share but 'xavier'; 'Nasi' and 'Ignasi' share no field."""
    rnd = random.Random(2)
    word = lambda n: "".join(rnd.choice(("bor", "gar", "sal", "tre", "mun", "vi", "lo", "que")) for _ in range(n))
    names = ["Xavier Borlamó", "Xavier Borlmó i Garlamús", "Nasi Saltreús", "Ignasi Saltreús i Ribtreoll"]
    names += [f"{g} {(b + word(3)).title()} i {word(3).title()}" for b in ("b", "g", "s") for g in ("Xavier", "Ignasi") for _ in range(25)] + [f"{g} Saltreús i {word(2).title()}" for g in ("Pere", "Anna") for _ in range(25)]
    names = list(dict.fromkeys(names))
    found, all_pairs, want = found_and_brute_force(spark, names, 3)
    assert found == want == all_pairs
    linked = {frozenset(x[:2]) for x in found}
    assert {0, 1} in linked and {2, 3} in linked


def people(rnd, n, *also):
    """Readings with slips, initials, titles, second given names, missing surnames and organisations of few syllables, so that many are linked."""
    word = lambda k: "".join(rnd.choice(("bor", "gar", "sal", "tre", "mun", "vi", "lo", "que", "nas")) for _ in range(k))
    out = [Reading(tuple(t), titled, org) for t, titled, org in also]
    while len(out) < n:
        given = rnd.choice(("ignasi", "nasi", "pere", "josep", "pep", "anna", "annieta", "lola", "dolors", "x", "gabriel", "biel", "maria teresa", "maite", "joan pau")).split(" ")
        surnames = [word(2) + rnd.choice(("anya", "ench", "")) for _ in range(rnd.randint(1, 2))]
        titled, org = rnd.random() < 0.15, rnd.random() < 0.15
        tokens = surnames if titled else [*given, *surnames]
        if org:
            tokens = rnd.choice((["fc"], ["f.", "comerc"], ["federacio", "comerc"], ["fco"])) + surnames
        k = rnd.randrange(len(tokens))
        t, at = tokens[k], rnd.randrange(len(tokens[k]))
        tokens[k] = rnd.choice((t, t, t[:at] + t[at + 1 :] or t, t[:at] + rnd.choice("aeb·ñ7") + t[at:], t[0]))
        out.append(Reading(tuple(tokens), titled, org))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_the_filter_keeps_every_pair_that_may_be_linked(seed):
    rnd = random.Random(seed)
    rs = people(rnd, 260, *[(list(r.tokens), r.titled, r.organisation) for pair in SAME + PART for n in pair if (r := read(n))])
    want = {(i, j) for i in range(len(rs)) for j in range(i + 1, len(rs)) if comparable(rs[i], rs[j]) and (compare(rs[i], rs[j]) or compare(rs[j], rs[i]))}
    got = [tuple(sorted(p)) for p in candidates(rs)]
    assert len(want) > 30 and want <= set(got) and len(got) == len(set(got))
    a, b = rs[:150], rs[150:]
    assert {(i, j) for i, j in want if i < 150 <= j} <= {(i, j + 150) for i, j in candidates(a, b)}


@pytest.mark.parametrize("seed", range(3))
def test_the_filter_by_frequencies_keeps_every_link(seed):
    rnd = random.Random(seed)
    rs = people(rnd, 200)
    counts = {t: rnd.choice((1, 2, 3, 4, 8, 40)) for r in rs for t in r.tokens}
    records = [(k, r, {t: counts[t] for t in r.tokens}) for k, r in enumerate(rs)]
    want = {(i, j) for i in range(len(rs)) for j in range(i + 1, len(rs)) if L._links(records[i], records[j])}
    got = [tuple(sorted(p)) for p in candidates(rs, counts=counts)]
    assert len(want) > 10 and want <= set(got) and len(got) < len(list(candidates(rs)))


def test_a_large_block_compares_few_pairs_in_full():
    """Readings that share a suffix and nothing else: their pairs are not all compared one by one."""
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("bcdfglmnprstv") + rnd.choice("aeiou") for _ in range(3))
    rs = [Reading((word(), word(), f"{word()}anya")) for _ in range(3000)]
    assert sum(1 for _ in candidates(rs)) < len(rs) ** 2 / 2 / 500


def test_parts_of_blocks_give_the_links_of_whole_blocks(spark):
    rs = list(dict.fromkeys(people(random.Random(9), 120)))
    df = spark.createDataFrame([(k, list(r.tokens), r.titled, r.organisation) for k, r in enumerate(rs)], "id long, tokens array<string>, titled boolean, organisation boolean")
    whole, parts = ({tuple(r) for r in L.edges(df, 4, n).collect()} for n in (10**6, 9))
    assert whole == parts and len(whole) > 20


@pytest.mark.parametrize("names", [SAME, PART])
def test_linked_readings_are_comparable(names):
    assert all(comparable(read(a), read(b)) and comparable(read(b), read(a)) for a, b in names)


def entities(spark, rows):
    df = spark.createDataFrame([(n, "x") for n in rows], "name string, entity string")
    groups = {}
    for r in L.linked(df).collect():
        groups.setdefault(r["entity"], set()).add(r["name"])
    return sorted(map(sorted, groups.values()))


def test_linking(spark):
    a = ["Gaspar Zarviniga i Llavinerç", "GASPAR ZARVINIGA I LLAVINERÇ | GP Mixt", "Gaspar Zarviinga y Llavinerç", "G. Zarviniga i Llavinerç", "Zarviniga i Llavinerç, Gaspar"]
    b = ["Narcís Zarviniga i Llavinerç", "Ciset Zarviniga i Llavinerç"]
    ambiguous = ["Sr. Zarviniga i Llavinerç"]
    got = entities(spark, a * 3 + b * 4 + ambiguous + ["mesa", None, "", "La presidenta"])
    assert got == sorted(map(sorted, [a, b, ambiguous]))


def test_linking_a_hot_name_and_an_empty_table(spark):
    assert entities(spark, ["Pere Pi i Mas"] * 500 + ["Anna Roc i Vila"]) == [["Anna Roc i Vila"], ["Pere Pi i Mas"]]
    assert entities(spark, []) == []


def test_pairs(spark):
    e = spark.createDataFrame([("a", 1), ("c", 1), ("b", 1), ("z", 2)], "name string, entity long")
    assert sorted(map(tuple, L.variant_pairs(e).collect())) == [("a", "b"), ("a", "c"), ("b", "c")]
