"""Long tokens are read whole, and recall alone sets the network's threshold."""

import random
import time

import numpy as np
from test_text_ops import DOC, secret_scores

from lodestone.llm import secrets

KEY = "ghp_Ab3dE6gH9jK2mN5pQ8sT1vW4yZ7bC0eF3hI6"


def test_key_in_the_middle_of_a_long_token(spark):
    text = "see " + "report.final.version." * 4 + KEY + ".and.the.other.pages" * 4 + " now"
    a, b = 4, len(text) - 4
    read = secrets.windows_of(text, a, b)
    assert all(any(text[k : k + 33].encode() in w for w in read) for k in range(a, b - 33))
    r = secrets.scan(spark.createDataFrame([(1, text, "s", "n")], DOC)).first()
    assert r["n_cnn"] == 1 and r["spans"] == f"cnn:{a}:{b}"


def test_recall_sets_the_threshold():
    noisy = [(t, a, b, int(y or k % 4 == 0)) for k, (t, a, b, y) in enumerate(secrets.generated_findings(5, 600))]  # hard ones among the secrets
    net = secrets.train(noisy)
    p = secret_scores(net, noisy)
    assert net.threshold < 0.5 and (p[np.array([x[3] for x in noisy]) == 1] >= net.threshold).mean() > 0.9


def test_spans_that_base_ones_cover_are_no_candidates():
    rnd = random.Random(8)
    for _ in range(500):
        spans = sorted((a := rnd.randrange(60), a + rnd.randint(1, 12)) for _ in range(12))
        taken = sorted((a := rnd.randrange(60), a + rnd.randint(1, 20), 0) for _ in range(rnd.randint(0, 9)))
        assert secrets._outside(spans, taken) == [(a, b) for a, b in spans if not any(s <= a and b <= e for s, e, _ in taken)]


def test_dump_of_keys_is_scanned_in_proportion_to_its_length():
    rnd = random.Random(9)
    line = lambda: "password = " + "".join(rnd.choices("abcdefgh0123", k=20)) + " id " + "".join(rnd.choices("ABCDEFGHabcdefgh0123456", k=24)) + "\n"
    text = "".join(line() for _ in range(160_000))  # about 10 MB
    t = time.time()
    taken = secrets.base_spans(text, text.encode())
    found = secrets.candidates(text, text.encode(), taken)
    assert len(taken) >= 160_000 and len(found) > 150_000
    assert time.time() - t < 20
