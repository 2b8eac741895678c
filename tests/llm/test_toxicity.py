import numpy as np

from tidemill.llm.toxicity import LabelModel, held_out, parts, toxicity


def test_parts():
    assert "wbadword" in parts("BadWord!!") and "pbad" in parts("badword") and parts("###") == []


def test_label_model_recovers_accuracies_and_shared_votes():
    rng = np.random.default_rng(4)
    y = rng.random(6000) < 0.2
    accuracy = [0.95, 0.9, 0.85, 0.8]
    votes = np.stack([np.where(rng.random(6000) < a, y, ~y) * 2 - 1 for a in accuracy], axis=1)
    copied = np.concatenate([votes, votes[:, 3:], votes[:, 3:]], axis=1)
    model = LabelModel.fitted(copied, np.where((votes.sum(axis=1) > 0), 0.8, 0.1), 0.2)
    assert np.abs(model.accuracies()[:4] - accuracy).max() < 0.06
    assert abs(model.posterior(copied).mean() - 0.2) < 0.01
    assert model.correlation[4, 5] > 0.9 and ((model.posterior(copied) > 0.5) == y).mean() > 0.94


def test_held_out_accuracy_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows, gold = [], []
    for i in range(900):
        words = [f"v{x}" for x in rng.integers(0, 200, 40)]
        bad = i % 6 == 0
        if bad:
            words[int(rng.integers(0, 40))] = ["nasty", "vilexa", "vilexo", "vilexus"][int(rng.integers(0, 4))]
        rows.append((i, " ".join(words)))
        gold.append((i, 1, int(bad)))
    rows += [(2000, None), (2001, ""), (None, "nasty v1"), (2002, "nasty " * 20_000), (5, rows[5][1])]
    gold += [(None, 1, 1), (3, 1, None), (4, 1, 7), (9999, 0, 1)]
    docs = spark.createDataFrame([(i, t, 1, 0.5) for i, t in rows], "doc_id long, text string, toxic int, score double").repartition(3)
    labels = spark.createDataFrame(gold, "doc_id long, quality int, toxic int")
    got = toxicity(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert len(held) > 100 and np.mean([r.predicted == (r.doc_id % 6 == 0) for r in held]) > 0.97
    assert next(r for r in got if r.doc_id == 2002).predicted == 1 and next(r for r in got if r.doc_id == 2001).predicted == 0
    assert toxicity(docs.limit(0), labels).count() == 0 and {r.predicted for r in toxicity(docs, labels.limit(0)).collect()} == {0}
    flipped = labels.withColumn("toxic", __import__("pyspark").sql.functions.when(held_out("doc_id", 5), 1).otherwise(labels["toxic"]))
    assert sorted(map(str, toxicity(docs, flipped).collect())) == sorted(map(str, got))


def test_label_model_sees_votes_only_and_rare_entries_count(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows, gold = [], []
    for i in range(1200):
        bad = i % 6 == 0
        words = [f"v{x}" for x in rng.integers(0, 200, 40)] + ([f"qoz{'bdfghjklmnprstvxz'[i // 6 % 17]}ula"] if bad else [])
        rows.append((i, " ".join(words)))
        gold.append((i, 1, int(bad if i % 50 else not bad)))
    seen, fitted = {}, LabelModel.fitted
    monkeypatch.setattr(LabelModel, "fitted", staticmethod(lambda votes, start, balance: seen.update(votes=votes, start=start) or fitted(votes, start, balance)))
    got = toxicity(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(gold, "doc_id long, quality int, toxic int")).collect()
    # Of the rows whose given label is wrong nearly all are told by their words: the labels are no votes.
    wrong = [r for r in got if r.doc_id % 50 == 0]
    assert np.mean([r.predicted == (r.doc_id % 6 == 0) for r in wrong]) > 0.9
    # About eleven rows hold each of the words, one in a hundred of all.
    assert np.mean([r.predicted for r in got if r.doc_id % 6 == 0]) > 0.95 and np.mean([r.predicted for r in got if r.doc_id % 6]) < 0.02
    assert seen["votes"].shape[0] == len(seen["start"]) and len(set(seen["start"])) == 2


def test_labels_without_one_entry_give_the_share(spark):
    # Every text has its own words, so no word is found in three toxic rows.
    docs = spark.createDataFrame([(i, " ".join(f"q{i}x{k}!!" for k in range(30))) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(60)], "doc_id long, toxic int")
    got = toxicity(docs, labels).collect()
    own = [i for i in range(60) if not next(r for r in got if r.doc_id == i).held_out]
    share = sum(i % 4 == 0 for i in own) / len(own)
    assert len(got) == 60 and all(abs(r.score - share) < 1e-9 and r.predicted == 0 for r in got)


def test_no_vote_speaks_against_its_class():
    rng = np.random.default_rng(5)
    y = rng.random(3000) < 0.3
    good = np.where(rng.random(3000) < 0.95, y, ~y).astype(int)
    # A voter for toxic that votes on clean rows mostly, and one for clean that votes on toxic rows.
    wrong, against = (~y & (rng.random(3000) < 0.8)).astype(int), -(y & (rng.random(3000) < 0.8)).astype(int)
    votes = np.stack([good, wrong, against], axis=1)
    model = LabelModel.fitted(votes, np.where(good > 0, 0.9, 0.05), 0.3)
    weighed = lambda *v: model.odds(np.array([v]))[0]
    abstained = np.log(model.table[1, :, 1] / model.table[0, :, 1])
    # A vote moves the odds by no less (for toxic) or no more (for clean) than nothing at all, whatever the abstention says.
    assert weighed(1, 1, 0) >= weighed(1, 0, 0) - max(0, abstained[1]) and weighed(1, 0, -1) <= weighed(1, 0, 0) - min(0, abstained[2])
    assert ((model.posterior(votes) > 0.5) == y).mean() > 0.9
