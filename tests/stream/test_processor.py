"""The state processor against a state kept in plain dicts, request by request."""

from pyspark.sql import Row

from screenrank.streaming.stateful import BUCKET_BITS, UserProfile, initial_profiles


class Value:
    def __init__(self, log):
        self.log, self.value = log, None

    def exists(self):
        self.log.append("exists")
        return self.value is not None

    def get(self):
        self.log.append("get")
        return self.value

    def update(self, value):
        self.log.append("update")
        self.value = value


class Map:
    def __init__(self, log):
        self.log, self.values = log, {}

    def containsKey(self, key):
        self.log.append("containsKey")
        return key in self.values

    def getValue(self, key):
        self.log.append("getValue")
        return self.values.get(key)

    def updateValue(self, key, value):
        self.log.append("updateValue")
        self.values[key] = value


class Handle:
    def __init__(self):
        self.log = []

    def getValueState(self, name, schema):
        return Value(self.log)

    def getMapState(self, name, key, value):
        return Map(self.log)


def event(mid, score, timestamp, head=None):
    return Row(uid=7, mid=mid, score=score, timestamp=timestamp, head_mids=head,
               head_scores=head and [1.0 - m / 1000 for m in head], complete=True if head else None)


def batch(p, h, events):
    h.log.clear()
    (out,) = p.handleInputRows((7,), iter(events), None)
    return out, list(h.log)


def test_a_batch_asks_the_state_only_for_what_it_does_not_know():
    p, h = UserProfile(n_recent=3, n_cands=2), Handle()
    p.init(h)
    out, asked = batch(p, h, [event(1, 2.0, 10), event(2, 3.0, 30, [1, 2, 3, 4, 5]), event(3, 4.0, 20)])
    # a new user: nothing stored, so no bitmap is asked for
    assert asked == ["get", "updateValue", "update"]
    assert (out.uid, out.mid, out.cand_mids, out.deep, out.seen) == (7, 2, [4, 5], False, [])
    assert [r["mid"] for r in out.recent] == [2, 3, 1]
    out, asked = batch(p, h, [event(1, 5.0, 40), event(2, 1.0, 5)])
    assert asked == ["get", "getValue", "update"]  # both items were marked before
    assert out.mid == 1 and [(r["mid"], r["score"]) for r in out.recent] == [(1, 5.0), (2, 3.0), (3, 4.0)]
    _, asked = batch(p, h, [event(1 << BUCKET_BITS, 5.0, 50)])
    assert asked == ["get", "getValue", "updateValue", "update"]


def test_a_very_long_batch_of_one_user_keeps_the_newest_and_marks_all():
    p, h = UserProfile(n_recent=3), Handle()
    p.init(h)
    out, _ = batch(p, h, [event(i, 1.0, 5000 - i) for i in range(3000)])
    assert out.mid == 0 and [r["mid"] for r in out.recent] == [0, 1, 2]
    assert sum(bin(b).count("1") for (v,) in p.seen.values.values() for b in v) == 3000


def test_seed_has_one_row_of_newest_and_one_per_bitmap(spark):
    ratings = [(u, m, 1.0 + m % 5, 100 + m) for u in (1, 2) for m in [*range(50), (1 << BUCKET_BITS) + u] * 2]
    rows = initial_profiles(spark.createDataFrame(ratings, "uid long, mid long, score double, timestamp long"), 5).collect()
    for u in (1, 2):
        own = [r for r in rows if r.uid == u]
        assert sorted(len(r["items"]) for r in own if r["items"]) == [1, 50]
        assert [len(r.newest) for r in own if r.newest] == [5] and len(own) == 3
    p, h = UserProfile(n_recent=5), Handle()
    p.init(h)
    for r in (r for r in rows if r.uid == 1):
        p.handleInitialState((1,), r, None)
    assert p.recent.value == ([((1 << BUCKET_BITS) + 1, 3.0, 4197)] * 2 + [(49, 5.0, 149)] * 2 + [(48, 4.0, 148)],)
    assert set(p.seen.values) == {(0,), (1,)}
