import hashlib
import random

from pyspark.sql import functions as F

from visitlens.llm import conversation as C


def plain(codes):
    """Cheapest cost and first cheapest audit, row by row; equally dear edits
    that reach one state hold no insertion more, so the lesser stays it."""
    best = {0: (0, "")}

    def insert(best):
        for _ in range(2):
            for s in list(best):
                c, a = best[s]
                to = C.NEXT[s]
                best[to] = min(best.get(to, (10**9, "")), (c + 2, a + "I"))
        return best

    for code in codes:
        after = {}
        for s, (c, a) in insert(best).items():
            for e, cost, step, to in C.arcs(code, s):
                if step:
                    after[to] = min(after.get(to, (10**9, "")), (c + cost, a + e))
        best = after
    best = insert(best)
    return min(best[s] for s in (0, 3) if s in best)


def test_auction_against_plain_paths():
    rng = random.Random(5)
    for n in [*range(9)] * 30 + [33, 64, 65, 200]:
        codes = "".join(rng.choice("suauabdSUA-_") for _ in range(n))
        assert C.repair_plainly(codes) == plain(codes), codes


def test_costs_between_states_compose():
    rng = random.Random(6)
    for _ in range(60):
        codes = "".join(rng.choice("suuaabdSUA-_") for _ in range(rng.randrange(1, 90)))
        at = rng.randrange(1, len(codes)) if len(codes) > 1 else 0
        two = C.before(C.between(codes[:at]), C.before(C.between(codes[at:]), C.LAST)) if at else \
            C.before(C.between(codes), C.LAST)
        assert two == C.distances(codes, C.LAST)


def plain_audit(rows):
    """(counts, cost, audit, hash) of a conversation's damaged rows."""
    def key(r):
        mark = f"{len(r[1].encode())}:{r[1]}{r[2]}"
        return (r[0] is not None, r[0] or 0, hashlib.sha256(mark.encode()).hexdigest())
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=key)
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    codes, seen, faults = "", set(), dict.fromkeys("bdt", 0)
    white = " \t\n\v\f\r"
    for _, r, x in rows:
        end = x.rstrip(white)[-1:]
        fault = "b" if not end else "d" if (r, x) in seen else "" if end in ".!?" else "t"
        seen.add((r, x))
        kind = r[:1] if r[:1] in ("s", "u", "a") else "-"
        codes += fault if fault in ("b", "d") else {"s": "S", "u": "U", "a": "A", "-": "_"}[kind] if fault else kind
        if fault:
            faults[fault] += 1
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = plain(codes)
    out, i, state = [], 0, 0
    for e in audit:
        if e == "D":
            i += 1
        elif e == "K":
            out.append(f"{rows[i][1]}:{rows[i][2]}")
            state = C.KEPT[rows[i][1][:1]][state]
            i += 1
        else:
            out.append(C.ROLE[state] + ":" + (rows[i][2] if e == "R" else ""))
            state, i = C.NEXT[state], i + (e == "R")
    return (gaps, faults["b"], faults["d"], faults["t"], illegal, cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def odd_conversations(seed=2, long=2600):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut off", "", None, " \t", "x" * 5000 + ".", "trailing. \n", "é.", "a\nb."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "unknown"]
    rows = []
    for conv in [*range(40), None]:
        rows += [(conv, rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts))
                 for _ in range(rng.randrange(1, 14))]
    rows += [(99, k, ("user", "assistant")[k % 2] if k % 7 else "system", f"Turn {k}" + ".!x"[k % 3]) for k in range(long)]
    rows += [(98, None, None, None)] * 3 + [(97, 1, "user", "Same.")] * 400
    rows += [(96, -(1 << 63), "user", "Hi."), (96, (1 << 63) - 1, "assistant", "Ho.")]
    return rows


def test_repair_against_plain(spark, monkeypatch):
    monkeypatch.setattr(C, "PIECE_BITS", 6)  # pieces of 64 rows
    rows = odd_conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.select("*", *[F.lit(7).alias(c) for c in ("conv", "pos", "mark", "code", "piece")]).repartition(5)
    got = {r.conv_id: tuple(r)[1:] for r in C.audit(df, df).collect()}
    want = {}
    for conv in {r[0] for r in rows}:
        want[conv] = plain_audit([r[1:] for r in rows if r[0] == conv])
    want[96] = ((1 << 63) - 1,) + want[96][1:]  # more missing turns than a long holds
    assert got == want


def test_damage_and_empty_tables(spark):
    rows = [(c, t, "user", "Hm. Ha!") for c in range(60) for t in range(4)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    import zlib
    kinds = [zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20 for c, t, _, _ in rows]
    assert C.damage(df).count() == len(rows) - kinds.count(0) + kinds.count(3)
    assert C.damage(df).where("text = ''").count() == kinds.count(1)
    assert C.damage(df).where("text = 'Hm Ha'").count() == kinds.count(2)
    nothing = df.where("1 = 0")
    assert C.audit(nothing, nothing).count() == 0
    got = C.audit(df, nothing).collect()
    assert len(got) == 61 and {(r.audit, r.cost, r.gaps) for r in got} == {("", 0, 0)}
    assert {r.repaired_sha256 for r in got} == {hashlib.sha256().hexdigest()}
