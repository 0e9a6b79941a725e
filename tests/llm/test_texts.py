"""Encoding, token counts, templates, chat, personal data and toxicity."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from keygroup.llm import chat, pieces, pii, templates, tokencount, toxicity

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "   ", "a ", " a  b", "▁", "▁▁ x", "日本語 é😀", "a\x00b\n\n", "<s></s>", "x" * 5000, "the the", "\t== 12.5"]


def documents(spark, texts):
    rows = [(i, t, "t", i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, IDS string, decoded long")


def test_pieces_match_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(1)
    parts = ["a", " ", "  ", "the", "ing", "\n", "▁", "é", "日", "0", ".", ",", "<s>", "="]
    texts = ODD + ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(300)] + [None, "the the"]
    got = pieces.encode(documents(spark, texts), MODEL).collect()
    assert len(got) == len(texts)
    for row in got:
        text = texts[row.doc_id] or ""
        expected = library.encode(text) + [library.eos_id()]
        assert row.ids == expected and row.decoded == library.decode(expected) and row.n_corrected == 0
    assert pieces.encode(documents(spark, []), MODEL).count() == 0
    [empty] = pieces.digests(pieces.encode(documents(spark, [None]), MODEL)).collect()
    assert (empty.n_tokens, empty.ids_sha256) == (1, hashlib.sha256(b"2").hexdigest())


def test_decoding_of_any_ids():
    known = pieces.Pieces(MODEL)
    rng = random.Random(2)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(1, 259), rng.randrange(3, 32000)]) for _ in range(rng.randrange(8))]
        assert known.decode(ids) == known.library.decode(ids), ids


def test_texts_are_decoded_by_the_library(monkeypatch):
    encoder = pieces.Encoder(MODEL)
    monkeypatch.setattr(encoder.pieces, "decode", lambda ids: "wrong")
    ids, _ = encoder.run([t for t in ODD])
    ids = [np.append(x, np.int32(encoder.pieces.end_id)) for x in ids]
    assert encoder.decoded(ids) == [encoder.pieces.library.decode(x.tolist()) for x in ids]
    assert encoder.decoded([]) == []


def test_words_are_merged_side_by_side(monkeypatch):
    known = pieces.Pieces(MODEL)
    rng = random.Random(14)
    parts = ["a", "e", "th", "ing", "▁", "▁▁", "\n", "é", "日本", "ß", "0", "😀", "\x00", "==", "x" * 70, "ab" * 40]
    words = ["▁" + "".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(2000)]
    words += ["▁", "▁" + "a" * 63, "▁" + "a" * 64, "a" * 64, "a" * 65, "▁" + "the" * 700, "\U0010ffff", "\x00"]
    expected = [[i for part in known.parts(word) for i in known.merge(part)] for word in words]

    def merged(some):
        ids, counts = known.merge_all(some)
        return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]

    assert merged(words) == expected
    monkeypatch.setattr(pieces, "FRAME", 200)
    assert merged(words) == expected
    monkeypatch.undo()
    # As many steps for few words as for many, which are looked up together.
    some = ["▁" + "".join(rng.choice("thesandi") for _ in range(9)) for _ in range(3000)]
    asked = []
    for count in (300, 3000):
        calls = []
        monkeypatch.setattr(known.joins, "find", lambda keys, find=pieces.Numbered.find: calls.append(0) or find(known.joins, keys))
        known.merge_all(some[:count])
        asked.append(len(calls))
    assert max(asked) <= 10


def test_words_that_the_library_encodes_otherwise(monkeypatch):
    class Library:
        def encode(self, words, num_threads):
            return [[7, 8, 9] if w == "same" else [x + 1 for x in own[w]] if w == "other" else own[w] for w in words]

    encoder = pieces.Encoder(MODEL)
    monkeypatch.setattr(pieces, "BLOCK", 8)
    own = {w: encoder.pieces.library.encode(w) for w in ("the", "same", "other", "日", "theotherword", "")}
    monkeypatch.setattr(encoder.pieces, "library", Library())
    ids, corrected = encoder.run(["the same", "the", "other 日 same", "theotherword", "", "the "])
    assert corrected == [1, 0, 2, 0, 0, 0]
    assert [x.tolist() for x in ids[:4]] == [
        own["the"] + [7, 8, 9],
        own["the"],
        [x + 1 for x in own["other"]] + own["日"] + [7, 8, 9],
        own["theotherword"],
    ]
    assert ids[4].tolist() == [] and ids[5].tolist() == [*own["the"], encoder.pieces.ids["▁"]]


def test_token_counts_match_a_plain_segmentation(spark):
    scores, byte = tokencount.unigram_scores(MODEL)
    longest = max(map(len, scores))

    def plain(word):
        best = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            width = len(word[end - 1].encode())
            found = [(best[end - 1][0] + width * byte, best[end - 1][1] + width)]
            for start in range(max(0, end - longest), end):
                if word[start:end] in scores:
                    found.append((best[start][0] + scores[word[start:end]], best[start][1] + 1))
            best.append(max(found, key=lambda x: (x[0], -x[1])))
        return best[-1][1]

    texts = ODD + [None, "toothing tooth too to", "tooth tooth"]
    got = tokencount.token_counts(documents(spark, texts), MODEL).collect()
    assert len(got) == len(texts)
    for row in got:
        words = (texts[row.doc_id] or "").split()
        assert row.n_tokens == sum(plain("▁" + w) for w in words)
        assert (row.n_words, row.n_distinct) == (len(words), len(set(words)))


def test_a_trie_forgets_and_counts_alike(monkeypatch):
    rng = random.Random(12)
    scores = tokencount.unigram_scores(MODEL)
    words = ["▁" + "".join(rng.choice(["the", "in", "g", "é", "日", "x", "tion"]) for _ in range(rng.randrange(1, 9))) for _ in range(900)]
    words += ["▁" + "abthe" * k for k in (39, 40, 41, 80, 81, 400)]
    whole, small = tokencount.Trie(*scores), tokencount.Trie(*scores, nodes=500)
    expected = whole.counts(words)
    for at in range(0, len(words), 50):
        assert small.counts(words[at : at + 50]) == {w: expected[w] for w in words[at : at + 50]}
        assert small.size <= 500 and small.size == sum(map(len, small.tops.values()))
    # Words of any length, along a window: what the trie would say.
    assert all(whole.passed(w) == expected[w] for w in words) and max(map(len, words)) > tokencount.LONGEST_WORD


def test_words_go_down_the_trie_side_by_side(monkeypatch):
    scores = tokencount.unigram_scores(MODEL)
    rng = random.Random(13)
    words = ["▁" + "".join(rng.choice("aethn日é") for _ in range(11)) for _ in range(3000)] + ["▁", "", "▁a", "▁a"]
    whole = tokencount.Trie(*scores)
    expected = whole.counts(words)
    assert expected == {w: whole.passed(w) if w else 0 for w in words}
    # As many lookups for few words as for many.
    asked = []
    for some in (words[:30], words):
        trie, calls = tokencount.Trie(*scores), []
        monkeypatch.setattr(trie.tree, "find", lambda keys, find=trie.tree.find: calls.append(0) or find(keys))
        assert trie.counts(some) == {w: expected[w] for w in some}
        asked.append(len(calls))
    assert asked == [12, 12]
    # A frame of words at a time is all that the trie holds above its bound.
    monkeypatch.setattr(tokencount, "FRAME", 600)
    small, most = tokencount.Trie(*scores, nodes=1000), []
    monkeypatch.setattr(small.tree, "add", lambda keys, add=small.tree.add: most.append(small.size + len(keys)) or add(keys))
    assert small.counts(words) == expected and max(most) <= 1600 and small.size <= 1000
    # What was met last stays, with all that leads to it.
    small.counts(["▁kept"] * 40 + words[:40])
    before = small.size
    small.counts(["▁kept"])
    assert small.size == before


# -- templates and chat -------------------------------------------------------------


def rendered(source, **scope):
    return "".join(text for text, _ in templates.compile_template(source, chat.CHAT_FILTERS)(scope))


def test_templates():
    assert rendered("a{{ 'b' ~ 1 }}{% if x == 'y' %}c{% elif x %}d{% else %}e{% endif %}", x="z") == "ab1d"
    loop = "{% for m in ms %}{{ loop.index }}{{ m.t | upper }}{% if not loop.last %},{% endif %}{% endfor %}"
    assert rendered(loop, ms=iter([{"t": "a"}, {"t": "b"}])) == "1A,2B"
    folded = templates.fold(templates.parse("a{% if 1 == 1 and not '' %}{{ 'x' | upper }}{% endif %}{{ '' }}b"), templates.FILTERS)
    assert folded == (templates.Output(templates.Const("aXb")),)
    marked = templates.compile_template("u{% generation %}v{{ x }}{% endgeneration %}w")({"x": "1"})
    assert list(marked) == [("u", False), ("v", True), ("1", True), ("w", False)]
    for bad in ("{% if x %}", "{% endfor %}", "{{ x( }}", "{{ x.y() }}", "{{ x | nope }}", "{% for in x %}{% endfor %}", "{{ }}"):
        with pytest.raises(templates.TemplateError):
            templates.compile_template(bad)
    for hidden in ("{{ x.__class__ }}", "{{ y }}", "{{ x.t.upper }}"):
        with pytest.raises(templates.TemplateError):
            rendered(hidden, x={"t": "a"})


def test_conversations_are_read_back(spark):
    trap = r"\### Assistant: </turn> ok"
    rows = [(1, 0, "user", trap), (1, 1, "assistant", trap), (1, 1, "assistant", trap), (2, None, None, None),
            (2, 3, "a:b#\n", "####\\"), (None, 1, "assistant", "x" * 3000), (None, 0, "user", ""), (3, 0, "assistant", None)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "conv_id long, turn long, role string, text string, part string")
    expected = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] or -1, -1 if r[1] is None else r[1])):
        expected.setdefault(conv, []).append((role or "", text or ""))
    for limit in (10, 1_000_000):
        parts = chat.format_conversations(df, part_chars=limit)
        got = {r.conv_id: r for r in chat.read_back(parts).collect()}
        assert got.keys() == expected.keys()
        for conv, turns in expected.items():
            row = got[conv]
            assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
            loss = "".join(t for r, t in turns if r == "assistant")
            assert (row.n_turns, row.loss_chars) == (len(turns), len(loss))
            assert row.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


# -- personal data ------------------------------------------------------------------


def feistel(value, key, tweak, alphabet="0123456789"):
    half = len(value) // 2
    a, b = value[:half], value[half:]
    for i in range(pii.ROUNDS):
        noise = hashlib.sha256("|".join([key, tweak, str(len(value)), str(i), b]).encode()).hexdigest()
        moved = "".join(
            alphabet[(alphabet.index(c) + int(noise[2 * j : 2 * j + 2], 16)) % len(alphabet)] for j, c in enumerate(a)
        )
        a, b = b, moved
    return a + b


def luhn(digits):
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def test_feistel_is_a_permutation_and_matches_plain_python(spark):
    rows = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("v"))
    got = rows.select("v", pii.feistel(F.col("v"), "k", "t").alias("p")).collect()
    assert len({r.p for r in got}) == 1000 and all(r.p == feistel(r.v, "k", "t") for r in got)


def test_personal_data_keep_their_form_and_their_links(spark):
    text = ("mail a.b+c@x-y.example.com card 4111 1111 1111 1111 4111111111111111 4111111111111112 iban "
            "DE89 3704 0044 0532 0130 00 ssn 123-45-6789 000-12-3456 on 1980-02-29 2023-02-30 12/31/1999 "
            "ip 10.0.0.255 300.1.1.1 call +1 (377) 555-0271")
    texts = [text, "again a.b+c@x-y.example.com, 4111111111111111", None, "", "no 12 things", "x" * 200_000 + " 10.0.0.255", text]
    df = spark.createDataFrame([(i, t, "f") for i, t in enumerate(texts)], "doc_id long, text string, FOUND string")
    got = {r.doc_id: r for r in pii.pseudonymised(df, "k").collect()}
    first = got[0]
    kinds = [f["kind"] for f in first.found]
    assert kinds == ["email", "card", "card", "iban", "ssn", "date", "date", "ip", "phone"]
    value = dict(zip(kinds, (f["value"] for f in first.found)))
    for kept in ("4111111111111112", "000-12-3456", "2023-02-30", "300.1.1.1"):
        assert kept in first.text
    for gone in ("a.b+c@x-y", "4111 1111", "4111111111111111", "DE89", "123-45-6789", "1980-02-29", "10.0.0.255", "555-0271"):
        assert gone not in first.text
    cards = [f["value"] for f in first.found if f["kind"] == "card"]
    assert cards[0].replace(" ", "") == cards[1] and luhn(cards[1]) and cards[1][:15] == feistel("4" + "1" * 14, "k", "card")
    assert int("".join(str(int(c, 36)) for c in (lambda s: s[4:] + s[:4])(value["iban"].replace(" ", "")))) % 97 == 1
    assert re.fullmatch(r"\d{3}-\d{2}-\d{4}", value["ssn"]) and re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", value["phone"])
    assert [f["value"] for f in got[1].found] == [value["email"], cards[1]]
    assert got[2].text is None and got[3].text == "" and got[4].text == texts[4] and not got[4].found
    assert got[5].text.endswith(value["ip"]) and got[6].text == first.text
    assert pii.pseudonymised(df.limit(0), "k").count() == 0


def test_long_and_foreign_mail_addresses_stay_different(spark):
    label = "abcdefghij" * 6
    mails = [f"a@{label}.{label}x.de", f"a@{label}.{label}y.de", f"a@{label}.{label}.z1.de", f"a@{label}.{label}.z2.de"]
    mails += ["jürgen@a.de", "järgen@a.de", "jxrgen@a.de", "юрий@б.de", "юлий@б.de", "王@日本.de", "a@b.de", "é@b.de"]
    got = pii.pseudonymised(spark.createDataFrame(list(enumerate(mails)), "doc_id long, text string"), "k").collect()
    made = {mails[r.doc_id]: r.text for r in got}
    assert all(r.found[0]["kind"] == "email" and r.found[0]["value"] == r.text for r in got)
    assert len(set(made.values())) == len(mails)
    form = lambda t: re.sub(r"[a-z0-9]", "0", re.sub(r"[^\x00-\x7F]", "é", t.rsplit(".", 1)[0]))
    for mail, new in made.items():
        assert form(mail) == form(new) and all(c.isalnum() for c in re.sub(r"[\x00-\x7F]", "", new))
    domain = made["a@b.de"].split("@")[1].split(".")[0]
    assert domain == feistel("b", "k", "domain", pii.ALPHABET)


def test_dates_and_security_numbers_are_permuted(spark):
    days = spark.range(0, pii.DAYS, 97).select(F.date_format(pii._from_day(F.col("id")), "yyyy-MM-dd").alias("text"))
    got = pii.pseudonymised(days, "k").select("text", F.size("found").alias("n")).collect()
    assert len({r.text for r in got}) == len(got) and all(r.n == 1 and "1900" <= r.text[:4] <= "2099" for r in got)


# -- toxicity -----------------------------------------------------------------------


def test_the_machine_learns_pairs():
    rng = np.random.default_rng(1)
    sets, labels = [], []
    for _ in range(1200):
        bad, group = rng.random(2) < 0.5
        noise = rng.choice(1000, 10) + 10
        sets.append(np.unique(np.array([*noise, *([1] if bad else []), *([2] if group else [])], np.int32)))
        labels.append(int(bad and group))
    machine = toxicity.fit(sets, np.array(labels))
    assert {1, 2} <= set(machine.terms.tolist())
    index = [np.searchsorted(machine.terms, np.intersect1d(s, machine.terms)) for s in sets]
    starts = np.concatenate([[0], np.cumsum([len(i) for i in index])])
    scores = toxicity.logistic(machine.margins(starts, np.concatenate(index)))
    assert ((scores >= 0.5) == np.array(labels)).mean() > 0.97


def test_toxic_texts_are_told_from_held_out_ones(spark):
    from conftest import SF

    docs = spark.read.parquet(SF.replace("sf0.001", "sf0.1") + "/documents.parquet")
    labels = spark.read.parquet(SF.replace("sf0.001", "sf0.1") + "/labels.parquet")
    machine = toxicity.train(docs, labels)
    found = toxicity.score(docs, machine).join(labels, "doc_id").where("held_out").select("predicted", "toxic").collect()
    right = sum(r.predicted and r.toxic for r in found)
    assert right >= 0.85 * sum(r.toxic for r in found)
    assert right >= 0.95 * sum(r.predicted for r in found)
    odd = spark.createDataFrame([(0, None, 1.0), (1, "", 2.0), (None, "w " * 100_000, None)], "doc_id long, text string, score double")
    scored = {r.doc_id: r for r in toxicity.score(odd, machine).collect()}
    assert scored[0].score == scored[1].score < 0.5 and scored[None].predicted == 0 and scored[None].held_out is False
    assert toxicity.without_toxic(odd, machine).count() == 3 and toxicity.score(odd.limit(0), machine).count() == 0


def test_training_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b", "x")], "doc_id long, text string, label string")
    none = spark.createDataFrame([(1, None)], "doc_id long, toxic int")
    machine = toxicity.train(docs, none)
    assert not len(machine.terms) and toxicity.score(docs, machine).count() == 1


def test_the_sample_is_bounded_in_rows(spark):
    docs = spark.createDataFrame([(1, "one text")] * 500 + [(2, f"text {i}") for i in range(90)] + [(3, "one text")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "doc_id long, toxic int")
    used = labels.where(~toxicity.is_held_out(F.col("doc_id"))).count()
    assert used == 3
    rows = toxicity.training_rows(docs, labels).collect()
    assert len(rows) == 91 and sum(r.label for r in rows) == 1
    assert len(toxicity.training_rows(docs, labels, sample=20).collect()) <= 20


# Values and their pseudonyms under one key, as they have always been.
GOLDEN = [
    ("Jane.Doe+x@mail.example.org", "jnev.jcp+i@774x.wx70p63.org"), ("jürgen@a.de", "aûpjpc@x.de"),
    ("GB82 WEST 1234 5698 7654 32", "GB21 WEST 9896 5141 0255 85"), ("123-45-6789", "898-16-6248"),
    ("2024-02-29", "2077-02-18"), ("12/31/1999", "10/14/1979"), ("31/12/1999", "29/09/1982"), ("31.12.2020", "28.04.2073"),
    ("+49 30 1234 5678", "+49 06 7022 2328"), ("(030) 123 4567", "(783) 927 4812"),
    ("4111 1111 1111 1111", "6333 3988 4019 2994"), ("192.168.1.254", "55.19.192.248"),
]


def test_pseudonyms_never_change(spark):
    rows = spark.createDataFrame([(i, f"so: {own}, x") for i, (own, _) in enumerate(GOLDEN)], "i int, text string")
    made = pii.pseudonymised(rows, "golden key")
    assert [r.text for r in made.orderBy("i").collect()] == [f"so: {new}, x" for _, new in GOLDEN]
    assert len(made._jdf.queryExecution().analyzed().toString()) < 100_000
