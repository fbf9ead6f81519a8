"""Personal data: linear time, the patterns as they are written, and the best of all segmentations."""

import random
import re
import time
import tracemalloc

from pelagia.llm import pii

OLD_REGION = re.compile(r"[^\s0-9@]*[0-9@]\S*(?:[ \t]+[^\s0-9@]*[0-9@]\S*)*")


def test_spans_are_those_of_the_patterns():
    rng = random.Random(6)
    for _ in range(6000):
        t = "".join(rng.choice("ab1290.@@_%+- \t\n()é-") for _ in range(rng.randint(0, 60)))
        want = [(m.start(), m.end(), k) for k in pii.KINDS for m in pii.BASE[k].finditer(t) if pii._valid(k, m.group())]
        assert pii.base_spans(t) == want, t
        assert [m.span() for m in pii.REGION.finditer(t)] == [m.span() for m in OLD_REGION.finditer(t)], t


def test_long_texts_take_linear_time():
    field = pii.SegmentField().train(pii.generated(300), epochs=2)
    for t in ("a" * 200_000 + " 1@", "1" * 200_000, "a@" * 60_000, "a.b@" + "c" * 200_000, "+1" * 10_000, "1." * 3 + "1" * 200_000):
        began = time.time()
        pii.all_spans(t, field)
        assert time.time() - began < 8, t[:10]


def test_decoding_is_the_best_segmentation():
    """Against every choice of candidate segments that don't overlap."""
    field = pii.SegmentField().train(pii.generated(400), epochs=3)
    rng = random.Random(12)
    seen = 0
    for region, _ in pii.generated(120, seed=5):
        region = region + rng.choice(["", " 12", " 4.4.4.4", " a@b.de"])
        scored = [(i, j, k, s - pii.MARGIN) for i, j, k, s in field._scores(pii.candidates(region))]
        scored = [x for x in scored if x[3] > 0]
        if len(scored) > 13:
            continue
        best = 0.0
        for mask in range(1 << len(scored)):
            chosen = sorted(x for b, x in enumerate(scored) if mask >> b & 1)
            if all(a[1] <= b[0] for a, b in zip(chosen, chosen[1:])):
                best = max(best, sum(x[3] for x in chosen))
        parts = pii._pieces(region)
        starts, ends = {a: k for k, (a, _) in enumerate(parts)}, {b: k + 1 for k, (_, b) in enumerate(parts)}
        worth = {(i, j, k): s for i, j, k, s in scored}
        got = sum(worth[starts[a], ends[b], k] for a, b, k in field.decode(region))
        assert abs(got - best) < 1e-9
        seen += best > 0
    assert seen > 40


def test_decoding_holds_no_list_of_segments():
    """A line of figures is one region; what is held beside it and its spans does not grow with it."""
    field = pii.SegmentField().train(pii.generated(300), epochs=2)
    peaks = []
    for n in (20_000, 200_000):
        line = "+1 2" * (n // 4)
        tracemalloc.start()
        assert field.decode(line) == []
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < peaks[0] + 300_000
    # Spans at any distance from each other are found, as they are alone.
    entity = "ab.cd@efgh.com"
    far = entity + " " + "1x " * 5000 + entity
    assert field.decode(entity) == [(0, 14, "email")]
    assert field.decode(far) == [(0, 14, "email"), (len(far) - 14, len(far), "email")]
