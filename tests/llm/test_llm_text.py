"""PII, decontamination, quality and language on small fixtures and held-out rows."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import decontaminate, langid, quality
from ledgerloom.llm.pii import find

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    odd = [int(c) for c in reversed(digits)]
    return sum(x if k % 2 == 0 else x * 2 - 9 * (x > 4) for k, x in enumerate(odd)) % 10 == 0


def base_spans(text):
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            value, digits = m.group(), re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in value.split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            yield kind, m.start(), m.end()


def test_base_spans_match_the_plain_expressions(spark):
    random.seed(2)
    parts = ["a@b.c", "x.y%z@q-r.st.uv", "@", "1.2.3.4", "256.1.1.1", "001.02.3.255", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111",
             "4111-1111-1111-1111", "+1 (017) 555-7713", "+", "12", "9", ".", "-", " ", "  ", "é", "😀", "\n", "_", "79927398713",
             "4222222222222", "a", "+49.", "0" * 25]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 14))) for _ in range(400)]
    texts += [None, "", "7" * 60_000, "a" * 60_000 + "@", "1 " * 30_000, "a@b.c_x@d.e", "a@b.c.d@e.f", "1.1.1.1 " * 300]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in find(rows).collect()}
    assert len(got) == len(texts)
    for doc, text in enumerate(texts):
        want = list(base_spans(text))
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert [tuple(b) for b in got[doc]["base"]] == want, text
        assert got[doc]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert got[doc]["n_card"] == sum(k == "card" for k, _, _ in want)


def test_patterns_find_unseen_identifiers(spark):
    seeds = [(k, f"text {k} please write to user{k}@mail.example.com today") for k in range(8)]
    unseen = [(100, "again please write to john(at)9mail today"), (101, "room 12 is free")]
    got = {r["doc_id"]: r for r in find(spark.createDataFrame(seeds + unseen, "doc_id long, text string")).collect()}
    assert [b["kind"] for b in got[100]["added"]] == ["email"]
    assert got[100]["spans"] == "email:22:35" and not got[101]["added"]
    assert got[3]["spans"].startswith("email:") and not got[3]["added"]


def test_spaced_identifiers_and_contexts_past_other_tokens(spark):
    """Numbers with spaces are one identifier; the context of seeds and tokens runs over what stands before."""
    seeds = [(k, f"text please phone +49 30 55577{k:02}1 today") for k in range(8)]
    seeds += [(20 + k, f"room 7 card 4111 1111 1111 1111 and 2 mail u{k}@mail.example.com") for k in range(8)]
    texts = {
        100: ("please phone 555 123 4567 today", "phone:13:25"),
        101: ("please phone (555) 123-4567, today", "phone:13:28"),
        102: ("and 2 mail john(at)9mail", "email:11:24"),
        103: ("and 2 mail u1@mail.example.com 12 34", "email:11:30"),
        104: ("please phone 555 123x 12", "phone:13:16"),
    }
    rows = seeds + [(k, text) for k, (text, _) in texts.items()]
    got = {r["doc_id"]: r["spans"] for r in find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: got[k] for k in texts} == {k: want for k, (_, want) in texts.items()}


def test_pii_nulls_ties_and_extra_columns(spark):
    rows = spark.createDataFrame(
        [(1, "a@b.c", "x", 5), (1, "a@b.c", "y", 6), (None, "a@b.c", None, None), (2, None, None, None)],
        "doc_id long, text string, row string, base long",
    )
    assert sorted((r["doc_id"] or 0, r["n_email"]) for r in find(rows).collect()) == [(0, 1), (1, 1), (1, 1), (2, 0)]
    assert find(rows.limit(0)).count() == 0


def words(n, seed, size=4000):
    pick = random.Random(seed)
    return [f"{pick.choice('bcdfgh')}{pick.choice('aeiou')}{pick.randrange(size)}q" for _ in range(n)]


@pytest.fixture(scope="module")
def leaks(spark):
    items = [(k, " ".join(words(20 + k, 100 + k))) for k in range(40)]
    docs, leaked = [], set()
    for k in range(300):
        body = words(150, 1000 + k)
        if k % 6 == 0:
            item, part = k // 6 % 40, items[k // 6 % 40][1].split()
            if k % 12 == 0:  # a paraphrase: some words changed, some put in
                for at in range(2, len(part), 8):
                    part[at] = "changed"
                part.insert(5, "added")
            at = 7 * k % 140
            body[at:at] = [w.upper() if k % 18 == 0 else w for w in part]
            leaked.add((k, item))
        docs.append((k, ", ".join(body), "x"))
    docs += [(900, None, "x"), (901, "", "x"), (902, items[0][1], None), (902, items[0][1], None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([*items, (None, "null id"), (77, None)], "item_id long, text string")
    return frame, bench, leaked | {(902, 0)}


def test_all_leaks_and_nothing_else(leaks):
    docs, bench, leaked = leaks
    got = decontaminate.contaminated(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == leaked
    assert sum(r["doc_id"] == 902 for r in got) == 2


def test_truncated_space_keeps_recall(leaks):
    """Candidates from half the rank against brute-force TF-IDF cosine: recall at least 0.9."""
    docs, bench, leaked = leaks
    items = [words(20 + k, 100 + k) for k in range(40)]
    encoded = [[w.encode() for w in item] for item in items]
    names = np.unique(np.concatenate([decontaminate.terms(w) for w in encoded]))
    matrix = np.zeros((40, len(names)))
    for k, w in enumerate(encoded):
        matrix[k, np.searchsorted(names, decontaminate.terms(w))] = 1
    rows = docs.sparkSession.createDataFrame(
        [(k, names[matrix[k] > 0].tolist(), (matrix[k][matrix[k] > 0] / np.sqrt(matrix[k].sum())).tolist()) for k in range(40)],
        "item_id long, terms array<int>, weights array<double>",
    )
    found, basis = decontaminate.latent_space(rows, rank=40)
    assert (found == names).all()
    unit = matrix / np.sqrt((matrix**2).sum(axis=1, keepdims=True))
    kept = np.sqrt(((unit @ basis) ** 2).sum(axis=1))
    assert (kept >= 0.9).mean() >= 0.9


@pytest.mark.parametrize("spaces", [8, 2])
def test_more_items_than_rank(spark, monkeypatch, spaces):
    """All verbatim copies are found with items well above the rank, in one pass and in several."""
    monkeypatch.setattr(decontaminate, "SPACES", spaces)
    items = [(k, " ".join(words(20 + k % 20, 5000 + k))) for k in range(3 * decontaminate.SPACE_ITEMS)]
    docs = [(k, " ".join(words(40, 9000 + k) + items[k][1].split() + words(40, 19000 + k))) for k in range(0, len(items), 3)]
    got = decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == {(k, k) for k, _ in docs}


@pytest.mark.parametrize("n_items", [40, 1000, 2048])
def test_latent_search_alone(spark, n_items):
    """Recall of the cosine candidates by themselves: copies and copies with a fifth of the words changed."""
    items = [words(20 + k % 20, 5000 + k) for k in range(n_items)]
    docs = []
    for k in range(0, n_items, max(1, n_items // 100)):
        changed = list(items[k])
        for at in range(0, len(changed), 5):
            changed[at] = f"other{k}x{at}"
        docs += [(k, words(40, 9000 + k) + part + words(40, 19000 + k)) for part in (items[k], changed)]
    frames = [spark.createDataFrame([(k, " ".join(w)) for k, w in rows], f"{name} long, text string")
              for name, rows in (("doc_id", docs), ("item_id", list(enumerate(items))))]
    (model, alone), = decontaminate.build(*frames)
    assert alone and all(len(s["columns"]) <= max(1, len(s["items"]) // 2) for s in model["spaces"])
    split = [[w.encode() for w in doc] for _, doc in docs]
    found = {(d, model["items"][i]) for d, i, begin, end, _ in decontaminate._latent(model, [decontaminate.terms(w) for w in split])
             if decontaminate._compare(model, i, split[d][begin:end])}
    assert sum((d, k) in found for d, (k, _) in enumerate(docs)) >= 0.9 * len(docs)


def test_near_copies_against_all_runs(spark):
    """Every run that holds enough of an item lies in a stretch of the item's rarest words."""
    random.seed(8)
    pool = [f"w{k}" for k in range(30)]
    items = [random.choices(pool, k=random.randint(1, 12)) for _ in range(25)]
    docs = [random.choices(pool, k=random.randint(1, 60)) for _ in range(40)]
    frames = [spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(rows)], f"{name} long, text string")
              for name, rows in (("doc_id", docs), ("item_id", items))]
    (model, _), = decontaminate.build(*frames)
    split = [[w.encode() for w in doc] for doc in docs]
    found = set()
    for d, i, begin, end in decontaminate._near_copies(model, [decontaminate.terms(w) for w in split]):
        runs = decontaminate._runs(model["words"][i], split[d][begin:end], model["counts"][i])
        if any(decontaminate._compare(model, i, run) for _, run in runs):
            found.add((d, i))
    wanted = set()
    for d, doc in enumerate(split):
        for i, item in enumerate(model["words"]):
            room = int(len(item) / decontaminate.COVERED)
            if any(decontaminate._compare(model, i, doc[k : k + room]) for k in range(len(doc))):
                wanted.add((d, i))
    assert found == wanted and len(wanted) > 20


def test_long_documents_are_cut_into_slices(spark, monkeypatch):
    """Leaks anywhere in a document of many slices, over their borders too, are found as in one piece."""
    item, body = words(30, 71), words(6000, 72)
    places = [0, 500, 990, 1010, 2985, 4100, 5999]
    for n, at in enumerate(places):
        body[at + n * len(item) : at + n * len(item)] = item
    frames = [spark.createDataFrame([(1, " ".join(w))], f"{name} long, text string")
              for name, w in (("doc_id", body), ("item_id", item))]
    (model, _), = decontaminate.build(*frames)
    shared, got = type("Shared", (), {"value": model}), []
    for size in (1 << 15, 512, 1000):
        monkeypatch.setattr(decontaminate, "GROUP_WORDS", size)
        for k in range(len(places)):
            end = places[k] + (k + 1) * len(item)
            doc = body[max(0, end - 400 * (k + 1)) : end]  # that copy ends a document of another length each
            batch = pa.table({"doc_id": [1], "row": [1], "text": [" ".join(doc).encode()]}).to_batches()[0]
            got.append((size, k, decontaminate._search(shared)(batch)["lcs_share"]))
    assert all(shares == [1.0] for _, _, shares in got)


def test_passes_are_bounded():
    """Spaces and passes keep to their numbers of items, spaces and words, and leave no item out."""
    for sizes in ([3] * 5000, [40_000] * 9, [10, 200_000, 10], [1]):
        passes = decontaminate._passes(sizes)
        assert [k for p in passes for space in p for k in space] == list(range(len(sizes)))
        for spaces in passes:
            held = [k for space in spaces for k in space]
            assert 0 < len(spaces) <= decontaminate.SPACES and max(map(len, spaces)) <= decontaminate.SPACE_ITEMS
            assert sum(sizes[k] for k in held) <= decontaminate.PASS_WORDS or len(held) == 1


def test_item_in_a_third_of_the_documents(spark):
    """Words that a leak itself makes common still find every leak, with rare words around it or not."""
    hot, single = " ".join(words(25, 1)), words(22, 2)
    filler = " ".join(single)  # the single leak's words in another order are in every third document
    docs = []
    for k in range(600):
        body = words(60, 700 + k, 10**9)
        if k % 3 == 0:
            body.insert(k % 50, hot)
        elif k % 3 == 1:
            body.insert(k % 50, " x ".join(sorted(single)))
        docs.append((k, " ".join(body)))
    docs += [(1000, " ".join(words(40, 3, 10**9)) + " " + filler), (1001, filler)]
    bench = spark.createDataFrame([(1, hot), (2, filler)], "item_id long, text string")
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(k, 1) for k in range(0, 600, 3)} | {(1000, 2), (1001, 2)}


def test_decontaminate_empty(spark, leaks):
    docs, bench, _ = leaks
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0


def test_common_subsequence_is_longest():
    random.seed(4)
    for _ in range(60):
        a, b = ([random.choice("abcd") for _ in range(random.randint(1, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
        assert sum(decontaminate.common_subsequence(a, b)) == table[-1][-1]


def test_quality_held_out(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = [r for r in quality.score_quality(docs, labels).collect() if r["held_out"] and r["doc_id"] in truth]
    good = [r["predicted"] for r in rows if truth[r["doc_id"]] == 1]
    bad = [r["predicted"] for r in rows if truth[r["doc_id"]] == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.1


def test_quality_without_both_classes(spark):
    docs = spark.createDataFrame([(1, "abc", 3.0), (2, None, 1.0), (None, "x", None)], "doc_id long, text string, score double")
    for labels in ([], [(1, 1), (2, 1), (None, 0), (1, 7)]):
        got = quality.score_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
        assert len(got) == 3 and len({r["score"] for r in got}) == 1 and all(0 <= r["score"] <= 1 for r in got)
    assert quality.score_quality(docs.limit(0), spark.createDataFrame([], "doc_id long, quality int")).count() == 0


def test_descent_separates():
    pick = np.random.default_rng(0)
    rows = [(np.sort(pick.choice(20, 6, replace=False)), np.ones(6)) for _ in range(200)]
    labels = np.array([int((r < 10).sum() > 3) for r, _ in rows])
    keep = np.array([(r < 10).sum() != 3 for r, _ in rows])
    rows, labels = [r for r, k in zip(rows, keep, strict=True) if k], labels[keep]
    weights, bias = quality.descend(rows, labels, 20, cost=10.0, rounds=200)
    assert all((weights[f] @ v + bias > 0) == bool(y) for (f, v), y in zip(rows, labels, strict=True))


def test_forward_sums_every_segmentation():
    held = langid.vocabulary(langid.default_vocabulary())
    probability = np.random.default_rng(1).random((held.size + 1, 2)) * 0.1
    for word in ("▁the", "▁straße", "▁一\U0001f600x"):
        edges = list(zip(*held.lattice([word]), strict=True))

        def total(at, lang, word=word, edges=edges):
            return 1.0 if at == len(word) else sum(
                probability[p, lang] * total(e, lang) for _, s, e, p in edges if s == at)

        got = langid.sliced_forward(held, ["▁x", word], probability)[1]
        assert np.allclose(np.exp(got), [total(0, 0), total(0, 1)])


def _logs_and_counts(held, word, probability):
    """Log sum and expected piece counts of a word by plain recurrences over positions, in logarithms."""
    edges = list(zip(*(x.tolist() for x in held.lattice([word])[1:]), strict=True))
    ends, starts = {}, {}
    for start, end, piece in edges:
        ends.setdefault(end, []).append((start, piece))
        starts.setdefault(start, []).append((end, piece))
    alpha, beta = {0: 0.0}, {len(word): 0.0}
    for at in range(1, len(word) + 1):
        alpha[at] = np.logaddexp.reduce([alpha[s] + np.log(probability[p]) for s, p in ends[at]])
    for at in range(len(word) - 1, -1, -1):
        beta[at] = np.logaddexp.reduce([beta[e] + np.log(probability[p]) for e, p in starts[at]])
    counts = {}
    for start, end, piece in edges:
        share = np.exp(alpha[start] + np.log(probability[piece]) + beta[end] - alpha[len(word)])
        counts[piece] = counts.get(piece, 0.0) + share
    return alpha[len(word)], counts


def test_long_words_are_summed_whole():
    held = langid.vocabulary(langid.default_vocabulary())
    rng = np.random.default_rng(3)
    probability = rng.random((held.size + 1, 2)) ** 3 * 1e-6 + 1e-9
    letters = np.array(list("aeinrst国語の😀"))
    words = ["▁" + "".join(rng.choice(letters, n)) for n in (1, 22, 23, 24, 25, 47, 48, 49, 100, 500)]
    words += ["▁" + "international" * 40, "▁"]
    langs = np.array([k % 2 for k in range(len(words))])
    plain = [[_logs_and_counts(held, w, probability[:, k]) for k in (0, 1)] for w in words]
    got = langid.log_sums(held, [w[1:] for w in words], probability)
    assert np.allclose(got, [[a[0], b[0]] for a, b in plain], rtol=1e-9)
    found = [{} for _ in words]
    for word, piece, share in langid.sliced_counts(held, words, langs, probability):
        for w, p, x in zip(word.tolist(), piece.tolist(), share.tolist(), strict=True):
            found[w][p] = found[w].get(p, 0.0) + x
    for w in range(len(words)):
        counts = plain[w][langs[w]][1]
        keys = set(counts) | set(found[w])
        assert np.allclose([found[w].get(k, 0) for k in keys], [counts.get(k, 0) for k in keys], rtol=1e-6, atol=1e-12)


def test_language_sample_by_different_texts(spark):
    """A text with many copies takes one place of the sample, and a language of one text is not left out."""
    rows = [("en", b"the house and the garden")] * 300 + [("en", f"word{k} and the other".encode()) for k in range(40)]
    rows += [("de", "das haus und der garten".encode())]
    training = spark.createDataFrame(rows, "lang string, text binary")
    held = langid.vocabulary(langid.default_vocabulary())
    for fit_rows in (20, 1000):  # a part of the English texts, all of them
        model = langid.fit(training, langid.default_vocabulary(), fit_rows=fit_rows)
        assert model["languages"] == ["de", "en"] and np.allclose(np.exp(model["prior"]), [1 / 341, 340 / 341])
        german, english = np.diff(langid.log_sums(held, ["garten", "garden"], model["probability"]), axis=1)[:, 0]
        assert german < 0
    assert english > 0


def test_language_held_out(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = [r for r in langid.detect(docs).collect() if r["held_out"] and truth[r["doc_id"]]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in rows]) > 0.98


def test_language_edges(spark):
    docs = spark.createDataFrame(
        [(20 + k, "the house and the garden " * 3, "en", 1) for k in range(6)]
        + [(30 + k, "das haus und der garten " * 3, "de", 1) for k in range(6)]
        + [(6, None, "en", 1), (7, "123 !!", "de", 1), (8, "", None, 1), (None, "und das ist der garten", None, 1), (9, "w" * 5000, None, 1)],
        "doc_id long, text string, lang string, letters int",
    )
    got = {r["doc_id"]: r for r in langid.detect(docs).collect()}
    assert [got[k]["lang_pred"] for k in (6, 7, 8)] == ["und"] * 3 and got[None]["lang_pred"] == "de"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r["lang_pred"] for r in langid.detect(unlabelled).collect()} == {"und"}
    assert langid.detect(docs.limit(0)).count() == 0
