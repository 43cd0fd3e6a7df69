import functools

from corpusloom.llm import mojibake

CLEAN = ["La última montaña está cerca de Añover", "Die schöne Straße führt über Köln…", "Наша новая река течёт через большой город", "今日は古い港で新聞を読む。", "“Quoted” – it’s fine", "Αυτή η μεγάλη θάλασσα", "être jusqu’à près Noël"]
TRAPS = ["Â and Ã are letters.", "├── a\n│   └── b", "√2 × 3 ≈ 4,24 ± 0,01 µm, 25 °C", "plain ascii", "CAMPAÑA ENSEÑÓ… MÁS", "Заголовок РЕКА СТАРАЯ", "", "  ", None]


def run(spark, texts):
    df = spark.createDataFrame([(i, t, "clash", True) for i, t in enumerate(texts)], "doc_id long, text string, restored string, lost boolean")
    return {r.doc_id: (r.restored, r.lost) for r in mojibake.restore(df, "doc_id", "text").collect()}


def test_chains(spark):
    base = CLEAN * 2 + TRAPS
    bad, want = [], {}
    for t in CLEAN:
        for a in ("cp1252", "latin-1", "cp437", "mac_roman", "cp1251"):
            bad.append((mojibake.garble(t, a), t))
        bad.append((mojibake.garble(mojibake.garble(t, "cp1252"), "cp1252"), t))
    r = CLEAN[2]
    bad.append((mojibake.swap(r, "cp1251", "cp1252"), r))
    # In places, with clean text around, and twice the same.
    mixed = CLEAN[0] + ". " + mojibake.garble(CLEAN[1], "latin-1")
    bad += [(mixed, CLEAN[0] + ". " + CLEAN[1])] * 2
    texts = base + [g for g, _ in bad] + ["Una ni�a lee", CLEAN[0] * 2000 + " " + mojibake.garble("mañana niño", "cp1252")]
    for i, (g, t) in enumerate(bad):
        if g != t:
            want[len(base) + i] = (t, False)
    want[len(base) + len(bad)] = (None, True)
    want[len(base) + len(bad) + 1] = (CLEAN[0] * 2000 + " mañana niño", False)
    assert run(spark, texts) == want


def test_empty(spark):
    assert run(spark, []) == {}
    assert run(spark, TRAPS) == {}


def test_long_runs(spark):
    """Unspaced text of any length: linear time, no dictionary entry."""
    bad = mojibake.garble("日本é" * 20_000, "latin-1")
    texts = CLEAN + [mojibake.garble(t, "latin-1") for t in CLEAN] + ["x" * 300_000 + " é", "日本é" * 20_000, bad]
    got = run(spark, texts)
    assert got[len(texts) - 1] == ("日本é" * 20_000, False) and len(texts) - 2 not in got and len(texts) - 3 not in got


def test_forms_can_be_undone():
    words = ["ñ", "Straße", "Эта", "日本", "…"]
    for chain, garbled in mojibake.forms(words):
        for t, form in zip(words, garbled, strict=True):
            if form is None or form == t:
                continue
            if chain.startswith("swap:"):
                assert mojibake.unswap(form, *chain.split(":")[1:]) == t
            else:
                table = {functools.reduce(mojibake.garble, chain.split(">"), c): c for x in words for c in x}
                lengths = sorted({len(g) for g in table})
                assert mojibake.by_characters(form, chain, table, lengths) == t
                assert mojibake.by_characters(form + "☃", chain, table, lengths) is None


def test_read_with_or_without_c1():
    table = {mojibake.garble(c, "cp1252"): c for c in "日本語“é"}
    lengths = sorted({len(g) for g in table})
    for word in ("日本語“é", "“日"):
        assert mojibake.by_characters(word.encode().decode("latin-1"), "cp1252", table, lengths) == word


POLISH = ["Nowa książka leży na półce", "Jestem pewien, że źródło jest święte", "Będę później, więc zacznij", "Śnieg pada w górach"]


def test_swaps_of_words_with_ascii_letters(spark):
    clean = POLISH * 3 + CLEAN
    for true, wrong in (("cp1250", "cp1252"), ("iso8859-2", "latin-1")):
        whole = ". ".join(POLISH)
        # The last word stands nowhere else.
        bad = [whole, whole + " mąż"]
        got = run(spark, clean + [mojibake.swap(t, true, wrong) for t in bad])
        assert got == {len(clean) + i: (t, False) for i, t in enumerate(bad)}


def test_one_swapped_word(spark):
    clean = POLISH * 3 + CLEAN + ["Ta książka też", "Inna książka…", "Наша река и новая дорога идёт"] + ["река и"]
    # Nothing else in the texts may change.
    cases = [("The {} is new – à côté, être.", "książka", "cp1250", "cp1252"), ("El {} año.", "река", "cp1251", "cp1252"), ("El {} à la année.", "река и", "cp1251", "cp1252")]
    bad = [t.format(mojibake.swap(w, a, b)) for t, w, a, b in cases]
    assert run(spark, clean + bad) == {len(clean) + i: (t.format(w), False) for i, (t, w, _, _) in enumerate(cases)}
