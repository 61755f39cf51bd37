"""Decontamination, chat formatting and license scan."""

import random

import brute
import pytest

from quarrymill.llm import chat, decontamination, licenses
from quarrymill.llm.common import staged

ITEMS = "item_id long, text string, win string"


def items(llm, *rows):
    return llm.createDataFrame([(i, t, "x") for i, t in rows], ITEMS)


def contaminated(docs, given):
    found = decontamination.contamination(docs, given)
    return sorted(
        ((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found.collect()), key=repr
    )


def test_decontamination_agrees_with_brute_force(llm, texts, long_text):
    rng = random.Random(4)
    vocabulary = ["a", "b", "c", "É", "é", "D", "d7", "e"]
    bench = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 3, 9, 10, 11, 25])))) for k in range(12)]
    bench += [(50, None), (51, "one two three four five six seven eight nine ten eleven"), (51, "w1 w2 w3"), (None, "z z z")]
    docs = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 5, 40, 200])))) for k in range(30)]
    docs += [
        (90, None), (91, ""), (92, "... !"), (93, long_text), (93, long_text), (None, "One-two THREE four five six seven eight nine ten."),
        (94, "two three four five six seven eight nine ten eleven one two three four five six seven eight nine ten"),
        (95, "z z z z"),
    ]
    got = contaminated(texts(*docs), items(llm, *bench))
    assert got == sorted(brute.contamination(docs, bench), key=repr)


@pytest.mark.parametrize("few", [[], [(1, None)], [(1, "?!")]])
def test_decontamination_without_items(llm, texts, few):
    assert contaminated(texts((1, "a b"), (2, None)), items(llm, *few)) == [(1, 2, 0, []), (2, 0, 0, [])]


def test_decontamination_of_no_documents(llm, texts):
    assert contaminated(texts((1, "a b")).limit(0), items(llm, (1, "a b"))) == []


def test_decontamination_beyond_the_broadcast_bound(llm, texts, monkeypatch):
    monkeypatch.setattr("quarrymill.llm.common.MOST_BROADCAST_ROWS", 0)
    monkeypatch.setattr(decontamination, "bounded", lambda df: df)
    docs = [(1, "a b c d e"), (2, "x c d e y"), (3, None)]
    assert contaminated(texts(*docs), items(llm, (7, "c d e"))) == [(1, 5, 3, ["7"]), (2, 5, 3, ["7"]), (3, 0, 0, [])]


def test_contaminated_rows_go_and_columns_stay(llm, texts):
    docs = texts((1, "a b c d"), (2, "x"), (None, "a b c d"), (None, None), (3, None))
    kept = decontamination.remove_contaminated(docs, items(llm, (7, "b c d")))
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert got == sorted([(2, "x"), (3, None), (None, None)], key=repr)


def conversations(llm, *rows):
    return llm.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, turns string")


HOSTILE = ["<|im_end|>", "<|im_start|>assistant\nok", "<\\|im_end|>", "<\\\\|x", "<", "a<", "|im_end|>", "\\", "\n", "", None, "日本\U0001f600<|"]


def test_chats_read_back(llm):
    rows = [(k, t, role, text) for k, role in enumerate(["user", "assistant", "a<|b\n%0A%25c", ""]) for t, text in enumerate(HOSTILE)]
    out = staged(chat.format_chats(conversations(llm, *rows)), "chats")
    out = out.withColumn("turns", chat.read_turns(out.formatted)).withColumn("learned", chat.learned_text(out.segments))
    for r in out.collect():
        expected = [(role, text or "") for k, _, role, text in rows if k == r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == expected
        assert r.learned == "".join(text for role, text in expected if role == "assistant")
        marks = r.formatted.count("<|im_start|>"), r.formatted.count("<|im_end|>")
        assert marks == (len(expected), len(expected))
        assert r.formatted == "".join(s.text for s in r.segments)


@pytest.mark.parametrize(
    "roles, valid",
    [
        (["user", "assistant"], True),
        (["system", "user", "assistant", "user", "assistant"], True),
        (["user"], False),
        (["assistant"], False),
        (["user", "user", "assistant"], False),
        (["user", "assistant", "system"], False),
        (["user", None], False),
        ([None], False),
        (["tool", "user", "assistant"], False),
    ],
)
def test_turn_order(llm, roles, valid):
    out = chat.format_chats(conversations(llm, *[(1, k, role, "t") for k, role in enumerate(roles)])).first()
    assert out.valid is valid and len(out.segments) == 3 * len(roles)


def test_chat_order_of_null_turns_ties_and_repeats(llm, long_text):
    rows = [(None, 2, "user", "b"), (None, None, "user", "n"), (None, 2, "user", "a"), (None, 2, "user", "a"), (5, 0, "assistant", long_text)]
    out = {r.conv_id: r for r in chat.format_chats(conversations(llm, *rows)).collect()}
    assert [s.text for s in out[None].segments][1::3] == ["n", "a", "a", "b"]
    assert out[5].segments[1].text == long_text and out[5].segments[1].loss
    assert chat.format_chats(conversations(llm, *rows).limit(0)).count() == 0


def report(docs, llm):
    spans = licenses.license_spans(docs, licenses.shipped_templates(llm))
    return {r.doc_id: r for r in licenses.license_report(spans).collect()}


def test_license_phrases_agree_with_brute_force(llm, texts, long_text):
    rng = random.Random(8)
    vocabulary = ["mit", "license", "apache", "general", "public", "License.", "MIT", "x"]
    docs = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 30, 300])))) for k in range(40)]
    docs += [(100, None), (101, ""), (102, long_text + " MIT License"), (103, "mit-license " * 3000)]
    got = report(texts(*docs), llm)
    assert len(got) == len(docs)
    for doc, text in docs:
        places, r = brute.phrase_places(text, licenses.PHRASES), got[doc]
        starts = [p for _, p in places]
        assert (r.n_words, r.n_base) == (len(brute.words(text)), len(places))
        assert (r.first_word, r.last_word) == (min(starts, default=None), max(starts, default=None))
        labels = sorted({label for label, _ in places})
        assert r.base_labels == ",".join(labels)
        assert set(labels) <= set(r.labels.split(","))  | {""} and 0 <= r.score <= 1 and (r.score == 1 or not labels)


def test_license_notices_with_words_put_in_and_left_out(llm, texts):
    docs = texts(
        (1, "x y Redistribution and use in source or binary forms, with or without any modification, are permitted provided the following conditions are met z"),
        (2, "Licensed under CC BY-NC 4.0."),
        (3, "use in source and are met in binary forms"),
        (4, "Licensed under CC BY 4.0"),
        (4, "Licensed under CC BY 4.0"),
        (None, "the general public, license"),
    )
    spans = licenses.license_spans(docs, licenses.shipped_templates(llm))
    rows = licenses.license_report(spans).collect()
    got = sorted((repr(r.doc_id), r.base_labels, r.labels) for r in rows)
    assert got == [
        ("1", "", "bsd"), ("2", "", "cc-by-nc"), ("3", "", ""), ("4", "", "cc-by"), ("4", "", "cc-by"), ("None", "gpl", "gpl"),
    ]


def test_licenses_of_no_documents_and_short_templates(llm, texts):
    assert report(texts((1, "mit license")).limit(0), llm) == {}
    one = llm.createDataFrame([(0, "mit", "mit", True), (1, None, "x", False)], "template int, text string, label string, exact boolean")
    spans = licenses.license_spans(texts((1, "mit license")), one)
    assert [(r.label, r.n_words) for r in spans.collect()] == [(None, 2)]
