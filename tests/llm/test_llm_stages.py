"""The pipeline's stages on small tables, against plain versions."""

from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import SF_DIR
from llm_cases import plain
from test_llm_dedup import near, shingle_set

import corpus_pipeline
from tierlake.llm import mixing


def pairs_around(seed, families=60):
    """Pairs of texts, most of them with a similarity from 0.80 to 0.85."""
    pick = random.Random(seed)
    texts = []
    for f in range(families):
        base = [f"f{f}w{i}" for i in range(pick.randint(98, 118))]
        other = list(base)
        for place in (20, 60) if f % 4 else (20, 50, 80):
            other[place] = f"f{f}x{place}"
        texts += [" ".join(base), " ".join(other)]
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_near_dedup_stage_is_that_of_brute_force(spark, seed):
    texts = pairs_around(seed)
    sets = [shingle_set(t) for t in texts]
    alike = [len(a & b) / len(a | b) for a, b in zip(sets[::2], sets[1::2], strict=True)]
    assert sum(0.80 <= s < 0.85 for s in alike) >= 30 and sum(s < 0.80 for s in alike) >= 10
    kept = corpus_pipeline.drop_near_copies(spark, plain(spark, texts), SF_DIR).collect()
    assert sorted(r.doc_id for r in kept) == sorted({root for _, _, root in near(texts, 80)})


def domains(toxic, prose=3000, junk=30, seed=1):
    """Texts of 30 tokens with their domains; 3 toxic ones are 0.1 % of the tokens."""
    pick = random.Random(seed)
    calm = [f"{a}{b}" for a in ("stone", "river", "cloud", "field", "lamp") for b in ("s", "ed", "ing", "er", "y")]
    noisy, rude = [f"#{i}$%" for i in range(20)], [f"VILE{i}" for i in range(20)]
    kinds = ["prose"] * prose + ["junk"] * junk + ["toxic"] * toxic
    stock = {"prose": calm, "junk": noisy, "toxic": rude}
    texts = [f"t{i} " + " ".join(pick.choice(stock[kind]) for _ in range(29)) for i, kind in enumerate(kinds)]
    return texts, kinds


@pytest.mark.parametrize("toxic, junk", [(3, 30), (0, 30), (400, 600)])
def test_few_toxic_tokens_take_no_prose(spark, tmp_path, toxic, junk):
    texts, kinds = domains(toxic, junk=junk)
    labels = [(i, int(k == "prose"), int(k == "toxic")) for i, k in enumerate(kinds)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    kept = corpus_pipeline.mix(spark, plain(spark, texts), str(tmp_path)).collect()
    assert all(texts[r.doc_id] == r.text for r in kept)
    n = {kind: sum(kinds[r.doc_id] == kind for r in kept) for kind in ("prose", "junk", "toxic")}
    assert len({r.doc_id for r in kept if kinds[r.doc_id] == "prose"}) >= 0.99 * 3000 and n["prose"] <= 1.01 * 3000
    for kind, there in (("junk", junk), ("toxic", toxic)):
        most = 3000 / 0.95 * mixing.TARGETS[kind]
        assert abs(n[kind] - min(there, most)) <= 4 * np.sqrt(most) * (there > most), kind
