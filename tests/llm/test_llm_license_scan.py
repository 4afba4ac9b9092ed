from llm_cases import ROWS, empty, frame

from ledgerlens.llm import license_scan as L


def one(spark, text):
    (row,) = L.findings(spark, frame(spark, [(1, text, "en", "s")])).collect()
    return row


def test_base_places(spark):
    r = one(spark, "All rights reserved. CC-BY / cc by x All-Rights\nReserved general public  license")
    assert (r.n_words, r.n_base, r.first_word, r.last_word) == (14, 5, 0, 11)
    assert r.base_labels == "cc-by,gpl,reserved" and r.score == 1.0
    r = one(spark, "all rights were reserved general public licenses")
    assert (r.n_base, r.first_word, r.last_word, r.base_labels) == (0, None, None, "")


def test_notice_with_words_put_in_and_left_out(spark):
    notice = ("Redistribution and use, in source and binary forms, with or without any modification are permitted "
              "provided that following conditions are met")
    r = one(spark, "before it " + notice + " after it")
    assert r.labels == "bsd" and 0.8 <= r.score < 1 and r.n_base == 0
    (span,) = [s for s in L.scan(spark, frame(spark, [(1, "before it " + notice, "en", "s")])).collect()
               if s.label == "bsd"]
    assert (span.first, span.last) == (2, 22)


def test_far_halves_are_not_one_span(spark):
    words = L.NOTICES[2][1].split()
    r = one(spark, " ".join(words[:9] + ["x"] * 60 + words[9:]))
    assert r.labels == "" and 0 < r.score < 0.8


def test_many_places_in_one_document(spark):
    r = one(spark, "all rights reserved " * 5000)
    assert (r.n_base, r.first_word, r.last_word) == (5000, 0, 14997)


def test_defined_cases(spark):
    rows = L.findings(spark, frame(spark, clashing=True)).collect()
    assert len(rows) == len(ROWS)
    got = {r.doc_id: r for r in rows}
    assert got[9].labels == "cc-by,cc-by-nc,reserved" and got[9].n_base == 3
    assert (got[1].n_words, got[1].labels, got[1].score) == (0, "", 0.0)
    assert [r for r in rows if r.doc_id == 5][0] == [r for r in rows if r.doc_id == 5][1]
    assert got[7].n_words == 9 and got[3].n_words == 0
    assert L.findings(spark, empty(spark)).count() == 0
