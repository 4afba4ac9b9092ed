import collections

from llm_cases import ROWS, WORD, empty, frame

from ledgerlens.llm import quality_rules as Q


def repeated(words):
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = {w for w, n in collections.Counter(windows).items() if n > 1}
    return len({i + j for i, w in enumerate(windows) if w in often for j in range(8)})


def test_repeated_words_against_brute_force():
    for text in ("a b c d e f g h " * 3, "a " * 30, "x y " * 4, "one two three four five six seven", "",
                 "p q r s t u v w z p q r s t u v w"):
        words = WORD.findall(text)
        assert Q.repeated_words(words) == repeated(words)


def test_line_rules():
    fails = lambda s: Q.line_fails(s, len(WORD.findall(s)))
    assert fails("Home | About | Contact") and fails("Read more.") and fails("a %% b $$ c ##")
    assert fails("© All rights reserved.") and fails("We value you; see our privacy policy for more on all of this.")
    assert fails("Short line without end")
    assert not fails("A plain sentence.") and not fails("Homes are built on hills and the homely few live in them all")


def test_verdicts(spark):
    clean = "\n".join(f"This {i} is plain a{i} sentence b{i} of a c{i} clean document." for i in range(10))
    menu = "\n".join(["Home | News | Shop"] * 9) + "\nThis is the only sentence of the page and it is not so very long at all."
    rows = [(1, clean, "en", "s"), (2, menu, "en", "s"), (3, clean + "\nHome | News", "en", "s"), (4, "Too short.", "en", "s"),
            (5, "the same eight words are here again now " * 9, "en", "s")]
    got = {r.doc_id: r["__verdict"] for r in Q.quality_rules(frame(spark, rows)).collect()}
    assert got[1].kept and got[1].clean_text == clean and not got[1].base_failed
    assert not got[2].kept and got[2].n_failed_lines == 9 and got[2].n_dup_lines == 8
    assert got[3].kept and got[3].clean_text == clean and got[3].n_failed_lines == 1
    assert got[4].base_failed and not got[4].kept
    assert got[5].base_failed and got[5].n_repeat_words == 72


def test_defined_cases(spark):
    rows = Q.quality_rules(frame(spark, clashing=True)).collect()
    assert len(rows) == len(ROWS)
    got = {r.doc_id: r["__verdict"] for r in rows}
    assert got[1].n_words == 0 and got[1].clean_text is None and got[2].clean_text == ""
    assert got[3].clean_text == " \n\t " and got[4].n_words == 60_000
    assert all(r.score == f"own {-1 if r.doc_id is None else r.doc_id}" for r in rows)
    assert Q.quality_rules(empty(spark)).count() == 0


def test_line_rules_in_other_languages():
    fails = lambda s: Q.line_fails(s, len(WORD.findall(s)))
    for line in ("Startseite.", "Hier klicken!", "Zum Inhalt.", "Accueil.", "Lire la suite...", "Inicio.", "Leer más.",
                 "Iniciar sesión!", "Wir weisen darauf hin, dass alle Rechte vorbehalten sind, auch die der Autoren dieses Werkes.",
                 "Ce site utilise des cookies pour vous offrir la meilleure des visites, et rien d'autre.",
                 "Nuestra política de privacidad explica en detalle lo que hacemos con todos esos datos."):
        assert fails(line), line
    for line in ("Anmeldende kamen.", "Inicios difíciles.", "Suchende fanden das alte Haus am Ende der langen Straße nicht mehr",
                 "Le soleil brille.", "La casa es grande."):
        assert not fails(line), line
