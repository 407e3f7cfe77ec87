import random

from llm.data import WORD, as_set, prose, rows, table, with_extra
from vantage.llm import quality_rules as Q

BASE = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def brute(row):
    text = row[1] or ""
    w = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = {}
    for i in range(len(w) - 2):
        grams.setdefault(tuple(w[i : i + 3]), []).append(i)
    covered = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(3)}
    n = len(w)
    return (
        row[0], n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered),
        n < 50 or 100 * len(covered) > 50 * n,
    )


def test_base_counts_equal_brute_force(spark):
    data = rows()
    got = as_set(Q.verdicts(with_extra(table(spark, data))), *BASE)
    assert got == sorted(map(brute, data), key=repr)


def test_empty_table(spark):
    assert Q.verdicts(table(spark, [])).count() == 0
    assert Q.clean(table(spark, [])).count() == 0


def test_lines_fail_by_rule():
    r = Q.LineRules()
    fails = lambda s: Q.line_fails(s.encode(), s.encode().split(), r)
    assert fails("word$$$ other### third%%%")
    assert fails("a | b | c | d |")
    assert fails("STOP!! NOW!! OR!! I!! CALL!! YOU!!")
    assert fails("so so so so and and and and")
    assert fails("Home page")
    assert fails("Please read our privacy policy.")
    assert not fails("Yes.")
    assert not fails("A line of plain prose that simply ends here.")
    assert not fails("a long heading without any closing sign at all")
    assert not fails("")


def test_removed_lines_and_lost_share(spark):
    rng = random.Random(5)
    good = prose(rng, "en", 120)
    some = good + "\nHome page\n" + prose(rng, "en", 30)
    bad = good[:200] + "\n" + "\n".join("x$$$ y### z%%%" for _ in range(60))
    docs = table(spark, [(1, good, "en", "s", 9), (2, some, "en", "s", 9), (3, bad, "en", "s", 9)])
    kept = {r.doc_id: r for r in Q.clean(docs).collect()}
    assert set(kept) == {1, 2}
    assert kept[1].text == good and kept[1].n_chars == len(good)
    assert kept[2].text == some.replace("Home page\n", "") and kept[2].n_chars == len(kept[2].text)


def test_clean_keeps_other_columns(spark):
    docs = with_extra(table(spark, rows()))
    assert Q.clean(docs).columns == docs.columns
    kept = {r.doc_id for r in Q.verdicts(docs).collect() if r.kept}
    assert {r.doc_id for r in Q.clean(docs).collect()} == kept


def test_page_furniture_in_every_language():
    r = Q.LineRules()
    fails = lambda s: Q.line_fails(s.encode(), s.encode().split(), r)
    for line in (
        "Cookies akzeptieren um diese Seite zu nutzen.", "DATENSCHUTZERKLÄRUNG lesen Sie bitte hier.", "Tous droits réservés par la maison.",
        "Lisez notre Politique de Confidentialité avant tout.", "Esta página utiliza cookies para todo.", "TÉRMINOS Y CONDICIONES de la casa entera.",
        "Startseite Kontakt Impressum Anmelden", "Home Contact About Login", "Accueil Contact Connexion Aide", "Inicio Contacto Aviso Legal",
    ):
        assert fails(line), line
    for line in (
        "Die Startseite ist heute neu gestaltet", "Kontakt Impressum Anmelden Hilfe.", "we contact about ten people at home",
        "Les conditions sont bonnes pour la pêche.", "Los términos de la carta son claros.",
    ):
        assert not fails(line), line
