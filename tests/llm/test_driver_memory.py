"""What the driver still holds when the pipeline goes on to its later stages."""

import weakref

from test_pipeline import make

from strata.llm import minhash, toxicity


def test_fit_gives_its_sample_back(spark, tmp_path, monkeypatch):
    make(spark, str(tmp_path))
    docs, labels = (spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("documents", "labels"))
    samples, left = [], []
    inner = toxicity.FactorizationMachine.fit

    def fit(self, rows, y, *a, **b):
        samples.extend(map(weakref.ref, rows))
        return inner(self, rows, y, *a, **b)

    monkeypatch.setattr(toxicity.FactorizationMachine, "fit", fit)
    monkeypatch.setattr(toxicity, "release_driver", lambda s: left.append(sum(x() is not None for x in samples)), raising=False)
    toxicity.fit_toxicity(docs, labels)
    assert samples and left == [0]  # released once, when nothing refers to the sample any more


def test_rounds_of_near_links_are_released(spark, tmp_path, monkeypatch):
    make(spark, str(tmp_path))
    events = []
    inner = minhash.open_buckets
    monkeypatch.setattr(minhash, "open_buckets", lambda *a: events.append("round") or inner(*a))
    monkeypatch.setattr(minhash, "release_driver", lambda s: events.append("release"), raising=False)
    near = minhash.near_dedup(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    assert "round" in events and all(events[i - 1] == "release" for i, e in enumerate(events) if e == "round")
    assert events[-1] == "release"
    assert near.count() == 242  # one exact and one near copy are gone
