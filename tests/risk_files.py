"""Small input files of the risk run, made from a seed."""

from __future__ import annotations

import csv
import os
import random

from riskfeat.sources.readers import NUMBER_COLUMNS, ORDINAL_COLUMNS, TEXT_COLUMNS


def _write(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows(rows)


def _moment(rng):
    return f"{rng.randrange(31)} days {rng.randrange(24):02d}:{rng.randrange(60):02d}:{rng.randrange(60):02d}.000000000"


def make_files(root: str, train: int = 60, test: int = 20, seed: int = 7) -> None:
    rng = random.Random(seed)
    users = [f"Train_{i}" for i in range(train)]
    scored = [f"TestB_{i}" for i in range(test)]
    labels = {u: int(i % 3 == 0) for i, u in enumerate(users)}
    _write(f"{root}/train/train_label.csv", ["user", "label"], labels.items())
    base_header = ["user", *TEXT_COLUMNS, *ORDINAL_COLUMNS, "service3_level", "province", "city", *NUMBER_COLUMNS]

    def person(u):
        return [
            u,
            *[rng.choice(["a", "b", ""]) for _ in TEXT_COLUMNS],
            *[rng.choice(["level 1", "level 12", ""]) for _ in ORDINAL_COLUMNS],
            "x",
            rng.choice([21, 26, 3]),
            rng.randrange(5),
            *[rng.randrange(10) for _ in NUMBER_COLUMNS],
        ]

    def trans(u, risky):
        return [
            [
                u, rng.choice("pq"), rng.choice(["i1", "i2", ""]), rng.choice(["o1", ""]),
                "bad" if risky and rng.random() < 0.8 else "fine", rng.choice(["t1", ""]),
                rng.choice([100, 200, 5000]), rng.choice(["ip1", "ip2", ""]), rng.choice(["n1", ""]), _moment(rng),
            ]
            for _ in range(rng.randrange(1, 12))
        ]

    def op(u, risky):
        return [
            [
                u, rng.choice(["k1", "k2"]), rng.choice(["m1", "m2", "m3"]), rng.choice(["d1", "d2", ""]),
                rng.choice(["ip1", "ip9"]), rng.choice(["n1", "n2"]), rng.choice(["w", ""]), rng.choice(["c1", "c2"]),
                _moment(rng),
            ]
            for _ in range(rng.randrange(1, 15))
        ]

    trans_header = ["user", "platform", "tunnel_in", "tunnel_out", "type1", "type2", "amount", "ip", "ip_3", "tm_diff"]
    op_header = ["user", "op_type", "op_mode", "op_device", "ip", "ip_3", "net_type", "channel", "tm_diff"]
    for part, people, name in (("train", users, "train"), ("test", scored, "testb")):
        _write(f"{root}/{part}/{name}_base.csv", base_header, [person(u) for u in people])
        # every tenth user has no transactions
        paying = [u for i, u in enumerate(people) if i % 10]
        _write(f"{root}/{part}/{name}_trans.csv", trans_header, [r for u in paying for r in trans(u, labels.get(u))])
        _write(f"{root}/{part}/{name}_op.csv", op_header, [r for u in people for r in op(u, labels.get(u))])
