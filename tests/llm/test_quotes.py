"""Quotation linking (8) against a plain walk over each conversation."""

import random
from collections import defaultdict

from godown.llm import quote_links as L


def test_parse():
    said, passages = L.parse("Hi\nOn Monday X wrote:\n> one\n> two\n>> deeper\n> three\nBye")
    assert said == "Hi\nBye" and passages == [(1, ["one", "two"]), (2, ["deeper"]), (1, ["three"])]
    assert L.parse("a > b\n\n\n\nc") == ("a > b\n\n\n\nc", []) and L.parse(None) == ("", [])
    assert L.parse("> only\n") == ("", [(1, ["only"])])


def conversations():
    rnd = random.Random(6)
    rows = []
    for c in range(25):
        texts = []
        for t in range(rnd.randint(1, 14)):
            own = "\n".join(f"Line {rnd.randint(0, 30)} of   talk {rnd.choice(['', c])}" for _ in range(rnd.randint(1, 3)))
            if texts and rnd.random() < 0.6:
                quoted = "\n".join("> " + x for x in rnd.choice(texts).split("\n"))
                own = rnd.choice(["Someone wrote:\n", "", "Before\n"]) + quoted + "\n" + own
            texts.append(own)
            rows.append((c, t, rnd.choice(["user", "assistant", None]), own))
    rows += [(90, 0, "user", "Hello\nthere"), (90, 1, "user", None), (90, 1, "user", None), (90, 2, "a", "> HELLO there\nyes"), (90, 3, "a", "> yes\n> nowhere"),
             (90, 4, "a", "> later words"), (90, 5, "a", "later words"), (None, 0, "a", "> yes"), (90, None, "a", "> yes"), (91, 0, "a", ""),
             (92, 0, "a", "word " * 60_000), (92, 1, "b", "> " + "word " * 60_000),
             (93, 0, "a", ">>> print('nobody said this line')\n> Block quote of\n> two lines, unknown\nmine"),
             (94, 3, "a", "A passage that is long enough"), (95, 4, "a", "X wrote:\n> a passage THAT is  long enough\nFrom afar"),
             (96, 1, "b", "a passage that is long enough"), (94, 1, "a", "> A passage that is long enough\n\n\n> nothing of the kind\nend")]
    return rows


def brute(rows):
    by_conv, out, linked = defaultdict(list), {}, {}
    for r in rows:
        if r[0] is not None and r[1] is not None:
            by_conv[r[0]].append(r)
    for c, messages in by_conv.items():
        said = defaultdict(set)
        for _, t, _, text in messages:
            said[t] |= set(L.units(L.parse(text)[0].split("\n")))
        parents = {}
        for _, t, _, text in messages:
            best, own = None, set()
            for k, (level, lines) in enumerate(L.parse(text)[1]):
                weight = defaultdict(int)
                for u, w in L.units(lines).items():
                    earlier = [s for s in said if s < t and u in said[s]]
                    if earlier:
                        weight[max(earlier)] += w
                if weight:
                    source = max(weight, key=lambda s: (weight[s], s))
                    best = min(best or (level, k, source), (level, k, source))
                    own.add(k)
            afar = {}
            for k, (_, lines) in enumerate(L.parse(text)[1]):
                whole = L.normalise("\n".join(lines))
                if k not in own and len(whole) >= L.LEAST_AFAR:
                    others = [(d, s) for d, ms in by_conv.items() if d != c for _, s, _, x in ms if whole in L.units(L.parse(x)[0].split("\n"))]
                    if others:
                        afar[k] = min(others)
            linked[c, t] = own | set(afar), afar[min(afar)] if afar else (None, None)
            if best:
                parents[t] = best[2]
        for _, t, _, _ in messages:
            root = t
            while root in parents:
                root = parents[root]
            out[c, t] = parents.get(t), root
    return out, linked


def test_links_and_order(spark):
    from pyspark.sql import functions as F
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {c: F.lit("own") for c in ("hash", "root", "place", "source", "level", "said", "first")})
    got = L.link_quotes(df.repartition(3)).collect()
    assert len(got) == len(rows)
    want, linked = brute(rows)
    said = defaultdict(set)
    for c, t, o, text in rows:
        said[c, t, o].add(L.without(L.segments(text)[0], linked.get((c, t), (set(), None))[0]))
        assert "\n".join(x for _, x in L.segments(text)[0]) == (text or "")
    for r in got:
        if r.conv_id is not None and r.turn is not None:
            assert (r.parent, r.root) == want[r.conv_id, r.turn]
            assert (len(linked[r.conv_id, r.turn][0]), (r.far_conv, r.far_turn)) == (r.n_linked, linked[r.conv_id, r.turn][1])
        assert r.said in said[r.conv_id, r.turn, r.role]
        assert r.chat.startswith(f"<|{r.role or 'unknown'}|>\n")
    by_key = {(r.conv_id, r.turn): r for r in got}
    assert by_key[93, 0].said == rows[-5][3]  # block quotes and prompts that nobody said stay
    assert by_key[95, 4].said == "From afar" and (by_key[95, 4].far_conv, by_key[95, 4].far_turn, by_key[95, 4].parent) == (94, 3, None)
    assert (by_key[94, 1].far_conv, by_key[94, 1].said) == (96, "> nothing of the kind\nend")
    by_conv = defaultdict(list)
    for r in got:
        by_conv[r.conv_id].append(r)
    for messages in by_conv.values():
        messages.sort(key=lambda r: r.position)
        assert [r.position for r in messages] == list(range(1, len(messages) + 1))
        keys = [(r.root is None, r.root, r.turn) for r in messages]
        assert keys == sorted(keys, key=lambda k: (k[0], k[1] or 0, k[2] or 0))
    assert sum(r.parent is not None for r in got) > 40
    assert next(r.n_linked for r in got if (r.conv_id, r.turn) == (90, 4)) == 0
    assert L.link_quotes(df.filter("false")).collect() == []
