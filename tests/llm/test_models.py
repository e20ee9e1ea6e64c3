import zlib

import numpy as np

from tests.llm.fixtures import frame, odd_rows, rows_of, with_clashes
from tidemill.llm import langid, pii, secrets, toxicity
from tidemill.llm.common import held_out


def out_of_training(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_language(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    found = langid.op9_language_id(spark, sf).collect()
    assert {r.doc_id: r.held_out for r in found} == {k: out_of_training(k) for k in truth}
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    odd = with_clashes(frame(spark, odd_rows())).drop("score")
    rows = langid.identify(odd, labelled=docs).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r.score <= 1 for r in rows)
    assert [(r.lang_pred, r.score) for r in rows if r.doc_id in (1, 2, 3, 4)] == [("und", 0.0)] * 4
    assert {r.lang_pred for r in langid.identify(odd, labelled=docs.limit(0)).collect()} == {"und"}
    assert langid.identify(frame(spark, []), labelled=docs).count() == 0


def test_language_equals_plain_sums(spark):
    texts = ["abc déf", "x" * 50, "ab", "Ünd \0 so"]
    counts = {"a": np.arange(1, langid._PAD + 1), "b": np.arange(langid._PAD, 0, -1)}
    langs, matrix = langid.log_matrix(counts)
    names, scores = langid.score_texts(texts, langs, matrix, langid._classes())
    for text, name, score in zip(texts, names, scores):
        grams, _ = langid.gram_buckets([text], langid._classes())
        logs = matrix[:, grams].astype(np.float64).sum(axis=1)
        assert name == langs[int(logs.argmax())]
        assert abs(score - 1 / np.exp(logs - logs.max()).sum()) < 1e-6


def test_toxicity(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    found = {r.doc_id: r for r in toxicity.op6_toxicity(spark, sf).collect()}
    held = [(found[k].score, y) for k, y in truth.items() if found[k].held_out]
    assert all(found[k].held_out == out_of_training(k) for k in found)
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in found.values())
    toxic, clean = ([s for s, y in held if y == label] for label in (1, 0))
    wins = np.mean([(a > b) + 0.5 * (a == b) for a in toxic for b in clean])
    assert wins > 0.7
    odd = with_clashes(frame(spark, odd_rows())).drop("score")
    rows = toxicity.toxicity(odd, labels.limit(0)).collect()
    assert [r.score for r in rows] == [rows[0].score] * len(odd_rows()) and rows[0].score < 1e-9
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_toxicity_learns_words():
    rng = np.random.default_rng(1)
    texts, labels = [], []
    for i in range(400):
        words = [f"w{rng.integers(300):03d}".translate(str.maketrans("0123456789", "abcdefghij")) for _ in range(40)]
        labels.append(int(i % 2))
        if i % 2:
            words[rng.integers(40)] = rng.choice(["vile", "rotten", "nasty"])
        texts.append(" ".join(words).encode())
    body, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    hashes, first, end = toxicity.word_hashes(body, offsets)
    rows = [(hashes[a:b], y) for a, b, y in zip(first, end, labels)]
    model = toxicity.train(rows[:300])
    scores = model.logits(hashes, first, end)
    right = (scores[300:] > 0) == (np.array(labels[300:]) == 1)
    assert right.mean() > 0.9


def test_surrogates(spark):
    texts = [
        "mail ann.lee@site.org or ANN.LEE@site.org, phone +1 (375) 555-4393 and 212-555-1234",
        "host 10.20.30.40 card 4111 1111 1111 1111 iban DE89 3704 0044 0532 0130 00 ssn 078-05-1120",
        "Frau Anna Schmidt met Mr. Paul Jones; again Frau Anna Schmidt. Госпожа Анна Иванова",
        "nothing here: 2024-01-02, 12.5.2024, 3.14159",
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + odd_rows()
    out = pii.replace_pii(with_clashes(frame(spark, rows))).collect()
    assert len(out) == len(rows)
    by_id = {r.doc_id: r for r in out if r.doc_id is not None and r.doc_id <= 3 and r.text}
    assert [by_id[i].n_entities if i in by_id else None for i in (0,)] == [4]
    new = by_id[0].text
    first, second = [new[a:b] for a, b, kind in pii.entities(new) if kind == "email"]
    assert first != "ann.lee@site.org" and first.upper() == second.upper() and first.endswith(".org")
    card = next(r.text for r in out if r.text and "card" in r.text)
    digits = "".join(c for c in card.split("card ")[1][:19] if c.isdigit())
    assert digits[0] == "4" and digits != "4111111111111111" and pii.luhn_digit(digits[:-1]) == digits[-1]
    iban = card.split("iban ")[1][:27].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    names = next(r.text for r in out if r.text and "Frau" in r.text)
    assert "Schmidt" not in names and names.split("Frau ")[1].split()[0] == names.split("Frau ")[2].split()[0]
    assert names.split("Frau ")[1].split()[0] in pii._GIVEN[("f", "latin")]
    assert next(r for r in out if r.text and "nothing" in r.text).n_entities == 0
    long = {r.doc_id: r.text for r in out}
    assert long[5] == odd_rows()[4][1]
    assert pii.replace_pii(frame(spark, [])).count() == 0


def test_surrogates_stay_distinct(spark):
    """All addresses of a small host space: every surrogate first drawn meets an original and is drawn again."""
    key = b"k"
    assert len({pii.permute(f"{i:03d}", key, "t") for i in range(1000)}) == 1000
    assert len({pii.surrogate("ip", f"10.0.{i // 256}.{i % 256}", key) for i in range(2000)}) == 2000
    emails = [f"{c}@a.de" for c in "abcdefghij"]
    out = pii.replace_pii(frame(spark, [(i, f"write {e}") for i, e in enumerate(emails)])).collect()
    new = [r.text.split()[1] for r in out]
    assert len(set(new)) == len(new) and not set(new) & set(emails)


def test_surrogates_of_full_domains(spark):
    """All names of a list, and all but one, are in the corpus, also with the exceptions joined instead of broadcast."""
    women, men = pii._GIVEN[("f", "latin")], pii._GIVEN[("m", "latin")][1:]
    names = [f"Frau {n}" for n in women] + [f"Herr {n}" for n in men]
    docs = frame(spark, [*enumerate(names), (51, f"{names[0]} and {names[1]}")])
    for limit in (1 << 26, 0):
        out = {r.doc_id: r.text for r in pii.replace_pii(docs, broadcast_bytes=limit).collect()}
        new = [out[i].split()[1] for i in range(len(names))]
        assert len(set(new)) == len(new) and not set(new) & {*women, *men}
        assert out[51] == f"Frau {new[0]} and Frau {new[1]}"


def test_phone_mentions_of_one_number():
    spellings = ["+1 (375) 555-4393", "+13755554393", "+1-375-555-4393"]
    assert len({pii.canonical("phone", v) for v in spellings}) == 1
    new = {pii.canonical("phone", pii.surrogate("phone", v, b"k")) for v in spellings}
    assert new == {pii.surrogate("phone", pii.canonical("phone", spellings[0]), b"k")}


def test_secrets(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id < 2500")
    found = secrets.scan_secrets(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    right, held = 0, 0
    for r in found:
        start, value, before, _, assigned = next(c for c in secrets.find(texts[r.doc_id]) if c[0] == r.start)
        assert len(value) == r.length
        if out_of_training(r.doc_id):
            held += 1
            right += r.is_secret == secrets.rule_label(value, before, assigned)
    assert held > 5 and right >= 0.95 * held
    odd = with_clashes(frame(spark, odd_rows() + [(20, "password=0123456789abcdef99"), (21, "AKIA")])).drop("score")
    assert [r.doc_id for r in secrets.scan_secrets(odd).collect() if r.doc_id == 20] == [20]
    marks = spark.createDataFrame([(20, 9, True), (20, 9, None)], "doc_id bigint, start bigint, label boolean")
    assert {r.score for r in secrets.scan_secrets(odd, marks).collect()} == {1.0}
    assert secrets.scan_secrets(frame(spark, [])).count() == 0


def test_secret_dictionary_covers_all_texts(spark):
    """A word of two texts among 3,000 counts, and a dictionary that is joined gives what a broadcast one gives."""
    rows = [(i, f"plain words here number{i % 7} abcdefghij{i:06d} end", "en", "a") for i in range(3000)]
    rows += [(i, "zyxwvut qrstnml key = zyxwvutqrstnml12", "en", "b") for i in (5000, 5001)]
    docs = frame(spark, rows)
    language, table = secrets.learn_language(docs)
    assert table is None and {"zyxwvut", "qrstnml", "plain"} <= language.words
    assert np.exp(language.logs[ord("z") - 97]).argmax() == ord("y") - 97
    one, other = (
        sorted((r.doc_id, r.start, r.sha256, tuple(r.features)) for r in secrets.candidates(docs, *secrets.learn_language(docs, limit)).collect())
        for limit in (1 << 26, 0)
    )
    assert one == other and len(one) >= 3002
    place = secrets.FEATURES.index("coverage")
    assert {r[3][place] for r in one if r[0] == 5000} == {14 / 16}


def test_secret_candidates_of_any_form():
    cases = {
        'password = "S3cr3t!9"': "S3cr3t!9", "pwd=hunter2": "hunter2", "secret: Tr0ub4dor&3 and": "Tr0ub4dor&3",
        "db_password_prod = 'a b c'": "a b c", '{"apiKey": "x$y%z"}': "x$y%z", "token=abcdefgh12345678!tail#9 end": "abcdefgh12345678!tail#9",
        "?token=abc1&user=me": "abc1", "DB_PASSWORDS := p4ss,": "p4ss",
    }
    for text, value in cases.items():
        assert [(text.index(value), value, True)] == [(a, v, assigned) for a, v, _, _, assigned in secrets.find(text)], text
    assert not [c for t in ("monkey: banana", "keyboard: new", "author: Ann", "password == x") for c in secrets.find(t)]
    assert not secrets.rule_judges("9f86d081884c7d659a2feaa0c55ad015", "the id ", False)
    assert not secrets.rule_judges("Q8zR-x2Lm9", "db_password_prod = ", True)
    assert secrets.rule_judges("river-stone-2024", "see ", False) and secrets.rule_judges("2024-01-02-1200", "on ", False)


def test_toxicity_in_a_script_without_blanks():
    rng = np.random.default_rng(2)
    signs = [chr(0x4E00 + i) for i in range(300)]
    texts, labels = [], []
    for i in range(400):
        run = "".join(rng.choice(signs, 120))
        labels.append(int(i % 2))
        if i % 2:
            at = rng.integers(100)
            run = run[:at] + rng.choice(["恶毒", "蠢货"]) + run[at:]
        texts.append(run.encode())
    body, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    hashes, first, end = toxicity.word_hashes(body, offsets)
    assert (end - first >= 120).all()
    model = toxicity.train([(hashes[a:b], y) for a, b, y in zip(first[:300], end, labels)])
    right = (model.logits(hashes, first, end)[300:] > 0) == (np.array(labels[300:]) == 1)
    assert right.mean() > 0.9


def test_toxicity_words_by_plain_loops():
    texts = ["Écoles, straßenbahnhaltestelle x", "", "你好 abcdefghi", "ab́c \U00020000d 1 2"]
    body = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *[len(t.encode()) for t in texts]])
    hashes, first, end = toxicity.word_hashes(body, offsets)

    def alone(word):
        raw = np.frombuffer(word.encode(), np.uint8)
        return toxicity.word_hashes(raw, np.array([0, len(raw)]))[0]

    want = [["écoles", "straßenbahnhaltestelle", "x"], [], ["你", "好", "abcdefghi"], ["ab́c", "\U00020000", "d"]]
    for words, a, b in zip(want, first, end):
        plain = [row for w in words for row in alone(w)[: -toxicity._GAP]]
        assert np.array_equal(hashes[a : a + len(plain)], np.array(plain).reshape(-1, toxicity.COLUMNS)) and b == a + max(len(plain), 1)
    found = alone("straßenbahnhaltestelle")[:, 1:]
    grams = {w[i : i + n] for w in ["straßenbahnhaltestelle"] for n in toxicity.GRAMS for i in range(len(w) - n + 1)}
    assert len(set(found[found != 0].tolist())) == len(grams)


def test_toxicity_learns_from_every_labelled_row(spark):
    names = ["".join(chr(97 + (i // 26**k) % 26) for k in range(4)) + "ox" for i in range(300)]
    rows = [(i, f"{names[i % 300]} was seen", "en", 0) for i in range(3600)]
    rows += [(i, f"{names[i % 300]} so vile it is", "en", 1) for i in range(3600, 3900)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, toxic int").repartition(4)
    docs, labels = table.drop("toxic"), table.select("doc_id", "toxic")
    body = " ".join(names).encode()
    slots = (toxicity.word_hashes(np.frombuffer(body, np.uint8), np.array([0, len(body)]))[0][:300, 0] >> np.uint64(44)).astype(int)
    for model in (toxicity.fit(docs, labels), toxicity.fit(docs, labels, task_rows=100)):
        assert model.known[slots].mean() > 0.9  # a word is in 13 rows; in a sample of 1,000 rows a class it is in 3
        texts = [b"aaaa was seen", b"aaaa so vile it is"]
        hashes, first, end = toxicity.word_hashes(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
        clean, toxic = model.logits(hashes, first, end)
        assert clean < 0 < toxic
