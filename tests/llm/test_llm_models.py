"""Rules, classifiers, chat formatting, mixing and the pipeline."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from dockline.llm import chat, mixing, neighbours, simhash, supervision, toxicity
from dockline.llm.labelled import labelled_texts
from dockline.llm.queries import DOMAIN_WEIGHTS, ORACLES, QUERIES

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows_of(frame, *columns):
    return sorted(map(tuple, frame.select(*columns).collect() if columns else frame.collect()), key=str)


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, long, repeated and clashing rows."""
    rows = [(1, None, "en"), (2, "", None), (3, "A plain text of more than ten words, which says nothing at all.", "en"),
            (3, "A plain text of more than ten words, which says nothing at all.", "en"), (None, "WITHOUT!! ID!!", "de"),
            (5, "long " * 40_000, "de"), (6, "### ||| %%% $$$ &&& *** <<< >>> ### ||| %%% *** $$$", None)]
    return spark.createDataFrame([(i, t, k, None, 0, 1.5, 7, "x") for i, t, k in rows],
                                 DOCS + ", score double, _label int, _fp string").repartition(2)


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels", "conversations", "embeddings")}


def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    inside = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside),
            n < 10 or 100 * len(inside) > 20 * n)


def test_base_columns_equal_brute_force(spark, odd, tables):
    docs = tables["documents"].select("doc_id", "text").unionAll(odd.select("doc_id", "text"))
    got = rows_of(supervision.quality_votes(docs), "doc_id", *supervision.BASE, "base_failed")
    assert got == sorted(((r["doc_id"], *plain_measures(r["text"])) for r in docs.collect()), key=str)


def test_kept_documents_follow_the_labels(spark, tables):
    votes = supervision.quality_votes(tables["documents"])
    joined = votes.join(tables["labels"], "doc_id").where("NOT base_failed").collect()
    assert all(r["kept"] for r in joined if r["quality"] == 1)
    assert np.mean([not r["kept"] for r in joined if r["quality"] == 0]) > 0.9
    assert not any(r["kept"] for r in votes.where("base_failed").collect())


def test_estimate_against_plain_expectation_maximisation():
    pick = np.random.default_rng(0)
    rules, size = len(supervision.RULES), 4000
    good = pick.random(size) < 0.8
    votes = np.where(pick.random((size, rules)) < 0.2, 0, np.where(pick.random((size, rules)) < 0.9, np.where(good, 1, 2)[:, None],
                                                                 np.where(good, 2, 1)[:, None]))
    patterns = votes @ 3 ** np.arange(rules)[::-1]
    every, counts = np.unique(patterns, return_counts=True)
    model = supervision.estimate(every, counts.astype(float))
    said = model.posterior(patterns) >= 0.5
    assert (said == good).mean() > 0.98 and abs(model.good - 0.8) < 0.03
    # One row per document instead of one per pattern.
    belief = np.where((votes == 2).any(1), 0.05, 0.95)
    for _ in range(200):
        table = np.array([[[(w * (votes[:, r] == v)).sum() for v in range(3)] for r in range(rules)] for w in (1 - belief, belief)])
        table += np.array([[1.0, 0.5, 1.5], [1.0, 1.5, 0.5]])[:, None, :]
        table /= table.sum(2, keepdims=True)
        prior = (belief.sum() + 1) / (size + 2)
        both = np.log(table)[:, np.arange(rules), votes].sum(2) + np.log([[1 - prior], [prior]])
        belief = 1 / (1 + np.exp(both[0] - both[1]))
    assert np.allclose(belief, model.posterior(patterns), atol=1e-6)


def test_rules_on_odd_rows(odd):
    kept = supervision.passing(odd)
    assert kept.columns == odd.columns and [r for r in rows_of(kept, "doc_id") if r != (6,)] == [(3,), (3,)]
    assert supervision.quality_votes(odd.limit(0)).count() == 0 and supervision.passing(odd.limit(0)).count() == 0


@pytest.mark.parametrize("name,label,modulus,remainder,needed", [
    ("op6_quality_neighbours", "quality", 3, 1, 0.9), ("op7_toxicity", "toxic", 4, 2, 0.85)])
def test_held_out_accuracy(spark, sf_dir, name, label, modulus, remainder, needed):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    got = QUERIES[name](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == remainder) for r in got)
    assert all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["predicted"] == r[label] for r in held]) >= needed


def test_held_out_labels_are_not_read(spark, tables):
    labels = tables["labels"]
    turned = labels.withColumn("toxic", F.when(F.expr("pmod(crc32(cast(cast(doc_id AS STRING) AS BINARY)), 4) = 2"),
                                               1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = toxicity.fit_toxicity(tables["documents"], labels)
    b = toxicity.fit_toxicity(tables["documents"], turned)
    assert a.toxic == b.toxic and a.ordinary == b.ordinary and np.array_equal(a.weights, b.weights)


@pytest.mark.parametrize("value", [0, 1])
def test_a_long_labelled_text_takes_no_place(spark, value):
    labels = spark.range(80).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    first = labels.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id")).first()["doc_id"]
    said = F.concat(F.lit("text "), F.col("doc_id").cast("string"))
    docs = labels.select("doc_id", F.when(F.col("doc_id") == first, F.repeat(F.lit("word "), 4_000_000)).otherwise(said).alias("text"))
    texts, label, share = labelled_texts(docs, labels, "toxic", F.lit(True), 30)
    assert share == 0.5 and (label == 0).sum() == (label == 1).sum() == 30
    assert max(map(len, texts)) < 20
    # In a class of long texts only, some are learnt from.
    texts, label, _ = labelled_texts(docs, labels, "toxic", F.lit(True), 30, 64)
    assert (label == 0).sum() >= 4 <= (label == 1).sum()


def test_neighbour_votes_equal_brute_force(tables):
    model = neighbours.fit_neighbours(tables["documents"], tables["labels"])
    texts = [r["text"].encode() for r in tables["documents"].limit(40).collect()]
    vectors = model.embed(texts)
    got = model.score(texts)
    for v, score in zip(vectors, got):
        near = sorted(((float(v @ w), int(y)) for w, y in zip(model.vectors, model.labels)), reverse=True)[:neighbours.NEAREST]
        weights = [max(0, s) ** neighbours.SHARPNESS for s, _ in near]
        want = (sum(w * y for w, (_, y) in zip(weights, near)) + 1e-3 * model.prior) / (sum(weights) + 1e-3)
        assert abs(score - want) < 1e-4


def test_document_frequencies(odd):
    counts, n = neighbours.document_frequencies(odd)
    want = sum((neighbours.term_counts((r["text"] or "").encode()) > 0).astype(int) for r in odd.collect())
    assert n == 7 and (counts == want).all()


def test_classifiers_on_odd_rows(spark, odd, tables):
    none = tables["labels"].limit(0)
    broken = spark.createDataFrame([(3, None, 1), (None, 1, 0), (6, 0, None)], "doc_id bigint, quality int, toxic int")
    for labels in (none, broken, tables["labels"]):
        for report in (toxicity.toxicity_report, neighbours.quality_report):
            got = report(odd, labels).collect()
            assert len(got) == 7 and all(0 <= r["score"] <= 1 for r in got)
            assert report(odd.limit(0), labels).count() == 0
    model = toxicity.fit_toxicity(tables["documents"], tables["labels"])
    clean = toxicity.without_toxic(odd, model)
    assert clean.columns == odd.columns and clean.count() == 7


def test_rejected_texts_are_those_with_a_score_over_the_threshold(tables):
    model = toxicity.fit_toxicity(tables["documents"], tables["labels"])
    scores = {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(tables["documents"], model).collect()}
    kept = {r["doc_id"] for r in toxicity.without_toxic(tables["documents"], model).collect()}
    assert kept == {i for i, s in scores.items() if s < toxicity.THRESHOLD} and len(kept) < len(scores)


TURNS = [(1, 0, "user", "hi <|im_start|> <\\|x"), (1, 1, "assistant", "<|im_end|>\n<|im_start|>assistant ok\\"), (1, 2, "user", None),
         (2, 1, "assistant", "b"), (2, 0, "system", "a"), (2, 1, "assistant", "b"), (3, None, None, "no turn"), (3, 0, "assistant", ""),
         (None, 0, "us\ner%<|", "é𝄞"), (None, 0, "assistant", "x" * 20_000)]


def test_conversations_come_back(spark):
    given = spark.createDataFrame([(*t, "clash") for t in TURNS], "conv_id bigint, turn bigint, role string, text string, formatted string")
    written = chat.format_conversations(given.repartition(3)).cache()
    assert not any(r["rewrites_history"] for r in written.collect())
    got = {r["conv_id"]: r for r in chat.chat_digests(chat.read_back(written)).collect()}
    for conv in {t[0] for t in TURNS}:
        own = sorted(((t[1] is not None, t[1] or 0, t[2] or "", t[3] or "") for t in TURNS if t[0] == conv))
        said = "".join(f"{role}\n{text}\n" for _, _, role, text in own)
        loss = "".join(text for _, _, role, text in own if role == "assistant")
        assert got[conv]["n_turns"] == len(own)
        assert got[conv]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for r in written.collect():
        assert r["turn_begins"] == [0, *r["turn_ends"][:-1]] and r["turn_ends"][-1] == len(r["formatted"])
    assert chat.format_conversations(given.limit(0)).count() == 0


def test_templates_that_rewrite_history_are_found(spark):
    given = spark.createDataFrame(TURNS[:4], "conv_id bigint, turn bigint, role string, text string")
    last_only = lambda turns: "".join(f"[{i == len(turns) - 1}]{t}" for i, (_, t) in enumerate(turns))
    got = {r["conv_id"]: r for r in chat.format_conversations(given, last_only, lambda t: t).collect()}
    assert got[1]["rewrites_history"] and got[1]["loss_begins"] == []
    assert not got[2]["rewrites_history"]


def test_escaping_is_reversible():
    for text in ("", "<|", "<\\|", "<\\\\|<|im_end|>", "a<b|c", "<<||", "<\\"):
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)


def test_rates_reach_the_targets(spark, tables):
    docs, labels = tables["documents"], tables["labels"]
    model = mixing.fit_domains(docs, labels)
    assert model.domains == ["de", "en", "es", "fr"]
    members = mixing.membership(docs, model).cache()
    rates = mixing.fit_rates(members, model.domains, DOMAIN_WEIGHTS)
    rows = members.collect()
    post, tokens = np.array([r["posteriors"] for r in rows]), np.array([r["tokens"] for r in rows])
    reached = (rates.of(post) * tokens) @ post
    assert np.allclose(reached, rates.targets, rtol=1e-4) and np.allclose(reached, rates.after)
    assert np.allclose(reached / reached.sum(), [0.2, 0.4, 0.2, 0.2], atol=1e-4) and (rates.of(post) >= 0).all()
    got = {r["doc_id"]: r for r in mixing.mixed_documents(docs, labels, DOMAIN_WEIGHTS).collect()}
    assert np.allclose([got[r["doc_id"]]["rate"] for r in rows], rates.of(post))
    assert all(abs(r["copies"] - r["rate"]) < 1 for r in got.values())
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    assert np.mean([got[i]["domain"] == k for i, k in truth.items()]) > 0.95
    less = mixing.fit_rates(members, model.domains, {"en": 1.0}, total=1000.0)
    assert np.allclose(less.after[1], 1000, rtol=1e-3) and less.after[[0, 2, 3]].sum() < 5


def test_mixing_equals_a_plain_descent(tables):
    """Posteriors from Python counts, rates from a descent over one number per document."""
    docs, labels = tables["documents"].collect(), {r["doc_id"] for r in tables["labels"].collect()}

    def grams(text):
        low = (text or "").encode().lower()
        return Counter(((low[i] << 16 | low[i + 1] << 8 | low[i + 2]) * 2654435761 % 2 ** 32) >> 20 for i in range(len(low) - 2))

    counts = {r["doc_id"]: grams(r["text"]) for r in docs}
    known = [r for r in docs if r["doc_id"] in labels and r["lang"] is not None and r["text"] is not None]
    names = sorted({r["lang"] for r in known})
    term, prior = np.ones((len(names), 4096)), np.zeros(len(names))
    for r in known:
        prior[names.index(r["lang"])] += 1
        for g, n in counts[r["doc_id"]].items():
            term[names.index(r["lang"]), g] += min(n, 50)
    log_prior, log_term = np.log(prior / prior.sum()), np.log(term / term.sum(1, keepdims=True))
    post, tokens = [], np.array([len((r["text"] or "").encode().split()) for r in docs], float)
    for r in docs:
        size = max(1, sum(counts[r["doc_id"]].values()))
        score = log_prior + sum((n * log_term[:, g] for g, n in counts[r["doc_id"]].items()), np.zeros(len(names))) / size ** 0.5
        score = np.exp(score - score.max())
        post.append(score / score.sum())
    post = np.array(post)
    share = np.array([DOMAIN_WEIGHTS[n] for n in names])
    had = tokens @ post
    goal = share * (had / share).max()
    curve = (tokens[:, None] * post ** 2).sum(0)
    gram = (post * tokens[:, None]).T @ post / np.sqrt(np.outer(curve, curve))
    rate = np.ones(len(docs))
    for _ in range(mixing.ROUNDS):
        off = (rate * tokens) @ post - goal
        if np.abs(off).max() <= mixing.CLOSE * goal.sum():
            break
        rate = np.maximum(0, rate - post @ (off / curve) / np.linalg.eigvalsh(gram).max())
    got = {r["doc_id"]: r for r in mixing.mixed_documents(tables["documents"], tables["labels"], DOMAIN_WEIGHTS).collect()}
    assert np.allclose([got[r["doc_id"]]["rate"] for r in docs], rate, atol=1e-3)
    assert [got[r["doc_id"]]["tokens"] for r in docs] == tokens.astype(int).tolist()


def test_domains_beyond_the_list_are_one(spark):
    pick = np.random.default_rng(2)
    words = [["".join(pick.choice(list("abcdefghijklmnop"), 6)) for _ in range(12)] for _ in range(8)]
    rows = [(i, " ".join(pick.choice(words[i % 8], 60)), f"d{i % 8}", None, 0) for i in range(400)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = docs.selectExpr("doc_id", "1 AS quality")
    weights = {"d7": 0.5, "d5": 0.25, mixing.OTHER: 0.25}
    model = mixing.fit_domains(docs, labels, weights=weights, most=3)
    assert model.domains == ["d0", "d5", "d7", mixing.OTHER] and not model.pooled
    members = mixing.membership(docs, model)
    rates = mixing.fit_rates(members, model.domains, weights, least=0.0)
    report = {r["domain"]: r for r in rates.report(spark).collect()}
    assert np.allclose([r["after"] for r in report.values()], [r["target"] for r in report.values()], rtol=1e-3, atol=60)
    assert report[mixing.OTHER]["before"] > 5 * 0.9 * 50 * 60 and report["d0"]["target"] == 0
    every = mixing.fit_domains(docs, labels, weights={f"d{i}": 1.0 for i in range(8)}, most=3)
    assert every.pooled == {"d3", "d4", "d5", "d6", "d7"} and len(every.domains) == 4
    share = mixing._shares(every.domains, {f"d{i}": 1.0 for i in range(8)}, every.pooled, True)
    assert np.allclose(share, [1 / 8] * 3 + [5 / 8])


def test_weights_that_nothing_serves_are_told(spark, tables):
    model = mixing.fit_domains(tables["documents"], tables["labels"])
    members = mixing.membership(tables["documents"], model)
    with pytest.raises(ValueError, match="no labelled document serves"):
        mixing.fit_rates(members, model.domains, {"en": 0.5, "xx": 0.5}, strict=True)
    with pytest.warns(UserWarning, match="xx"):
        mixing.fit_rates(members, model.domains, {"en": 0.5, "xx": 0.5}, total=100.0)


def test_one_row_of_each_group_stays(spark, odd):
    rows = [(1, "a b c d e f g", "x"), (1, "a b c d e f g", "x"), (2, "a b c d e f g", "y"), (3, None, "n"), (4, "", "e"), (None, "other words here now", "z"),
            (None, "other words here now", "z"), (7, "something else again today", "q")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _fp string").repartition(3)
    kept = simhash.without_near_copies(docs)
    assert kept.columns == docs.columns
    assert rows_of(kept) == sorted([(1, "a b c d e f g", "x"), (3, None, "n"), (None, "other words here now", "z"), (7, "something else again today", "q")], key=str)
    assert simhash.without_near_copies(docs.limit(0)).count() == 0


def test_mixing_keeps_every_document_and_column(spark, tables, odd):
    out = mixing.mixed(tables["documents"], tables["labels"], DOMAIN_WEIGHTS)
    assert out.columns == tables["documents"].columns
    assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in tables["documents"].collect()}
    for labels in (tables["labels"], tables["labels"].limit(0)):
        some = mixing.mixed(odd, labels, DOMAIN_WEIGHTS)
        assert some.columns == odd.columns and some.count() >= 7
        assert mixing.mixed(odd.limit(0), labels).count() == 0 and mixing.mixed_documents(odd.limit(0), labels).count() == 0


def test_chat_equals_its_sql(spark, sf_dir):
    from tools.check import compare, connect
    assert compare(QUERIES["op8_chat"](spark, sf_dir), connect(sf_dir), ORACLES["op8_chat"]) == ""


def plain_windows(text, size=60):
    """Words laid into windows of at most ``size`` bytes one after the other; a longer word is a window of its own."""
    blank, out, at = b" \t\n\r\f\v", [], 0
    while at < len(text):
        if text[at] in blank:
            at += 1
            continue
        end = at + size
        if end < len(text) and text[end] not in blank:
            while end > at and text[end] not in blank:
                end -= 1
            if end == at:
                end = at + size
                while end < len(text) and text[end] not in blank:
                    end += 1
        out.append(text[at:end])
        at = max(at + 1, min(end, len(text)))
    return out


def test_toxicity_equals_plain_zstandard_calls(spark, tables, odd):
    """Every score again from single compressions without a prepared dictionary, a new compressor for each call."""
    rng = np.random.default_rng(2)
    common = ["word%s" % a for a in "abcdefghijklmnopqrst"] + ["plain", "text", "of", "the", "city"]
    bad = ["zorgblat", "krimvexing", "quxhound"]
    rows = [(i, " ".join(rng.choice(common, 40)) + (" " + " ".join(rng.choice(bad, rng.integers(1, 5))) + " end") * (i % 3 == 0)) for i in range(240)]
    model = toxicity.fit([t.encode() for _, t in rows], np.array([i % 3 == 0 for i, _ in rows]).astype(int), 0.2)
    given = zstandard.ZstdCompressionParameters(
        window_log=16, hash_log=16, chain_log=16, search_log=6, min_match=5, strategy=6, target_length=32,
        write_content_size=False, write_checksum=False, write_dict_id=False)

    def length(window, content):
        content = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(dict_data=content, compression_params=given).compress(window))

    def plain(text):
        windows = [b" " + w + b" " for w in plain_windows((text or "").encode().lower())]
        gains = sorted((length(w, model.ordinary) - length(w, model.toxic + model.ordinary) for w in windows), reverse=True)
        best = [max(0, g) for g in gains[:3]] + [0] * (3 - len(gains))
        if best[0] == 0:
            return model.silent
        return 1 / (1 + np.exp(-(np.array([1.0, *best, np.log1p(len(windows))]) @ model.weights)))

    made = spark.createDataFrame([(1000 + i, t) for i, t in rows], "doc_id bigint, text string")
    docs = tables["documents"].select("doc_id", "text").unionByName(made).unionByName(odd.where("length(text) < 1000 OR text IS NULL").select("doc_id", "text"))
    want = sorted(((r["doc_id"], plain(r["text"])) for r in docs.collect()), key=str)
    got = sorted(map(tuple, toxicity.toxicity_scores(docs, model).collect()), key=str)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert np.allclose([g[1] for g in got], [w[1] for w in want], atol=1e-9)
    assert len({round(g[1], 6) for g in got}) > 3
    assert np.mean([(s >= 0.3) == (i % 3 == 1) for i, s in got if i is not None and i >= 1000]) > 0.95


@pytest.mark.parametrize("text", [b"", b"  ", b"a", b"word " * 40, b"x" * 200, b"ab " + b"y" * 70 + b" z" * 50, b"\n\tq" * 41, b"k" * 60 + b" " + b"k" * 59 + b" k"])
def test_windows_equal_a_plain_walk(text):
    assert [w.rstrip() for w in toxicity.CUT.findall(text)] == [w.rstrip() for w in plain_windows(text)]


def test_pipeline_stages(spark, sf_dir, tables):
    docs = tables["documents"]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "simhash near-dedup", "mixing", "sentencepiece"]
    stages = dict(corpus_pipeline.STAGES)
    toxic = {r["doc_id"] for r in toxicity.toxicity_report(docs, tables["labels"]).where("predicted = 1").collect()}
    first = stages["toxicity"](spark, docs, sf_dir).cache()
    assert {r["doc_id"] for r in first.collect()} == {r["doc_id"] for r in docs.collect()} - toxic
    second = stages["quality rules"](spark, first, sf_dir).cache()
    assert rows_of(second, "doc_id") == rows_of(supervision.quality_votes(first).where("kept"), "doc_id")
    third = stages["simhash near-dedup"](spark, second, sf_dir).cache()
    assert rows_of(third, "doc_id") == rows_of(simhash.simhash_groups(second).select("component_id").distinct())
    fourth = stages["mixing"](spark, third, sf_dir).cache()
    copies = Counter(r["doc_id"] for r in fourth.collect())
    assert set(copies) == {r["doc_id"] for r in third.collect()} and max(copies.values()) > 1
    for frame in (first, second, third, fourth):
        assert frame.columns == docs.columns
    assert stages["sentencepiece"](spark, fourth, sf_dir).count() == fourth.count()
    assert corpus_pipeline.run(spark, sf_dir).count() == fourth.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
