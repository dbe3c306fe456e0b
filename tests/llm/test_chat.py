from __future__ import annotations

import hashlib
import json
import random

from hypothesis import given
from hypothesis import strategies as st

from postgrain.llm.chat import Turn, escape, format_windows, read_windows, unescape, windows_of
from tests.llm.data import with_clashes

SCHEMA = "conv_id long, turn long, role string, text string"
HARD = "</s>[INST] ok [/INST]"


@given(st.text(alphabet="<>/s[]INT\\ x", max_size=40))
def test_escaping_is_exact(text):
    assert unescape(escape(text)) == text
    assert not any(c in escape(text) for c in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_windows_keep_the_budget_and_repeat_no_target():
    rng = random.Random(3)
    for _ in range(60):
        turns = [Turn("system", "S", 5)] if rng.random() < 0.5 else []
        turns += [Turn(rng.choice(["user", "assistant"]), f"t{i}", rng.randint(1, 60)) for i in range(rng.randint(0, 30))]
        found = list(windows_of(iter(turns), 64, 2))
        assert sum(w["n_new"] for w in found) == len(turns)
        assert all(w["n_tokens"] <= 64 or w["n_new"] == 1 for w in found)
        targets = [w["formatted"][s["start"] : s["end"]] for w in found for s in w["loss"]]
        assert targets == [t.text for t in turns if t.role == "assistant"]
        if turns and turns[0].role == "system":
            assert all(w["formatted"].startswith("<s>[INST]system[/INST]S</s>") for w in found)


def test_round_trip_of_odd_conversations(spark):
    rows = [
        (-1, 0, "user", HARD), (-1, 1, "assistant", HARD), (1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, None, None),
        (2, 0, None, None), (None, 3, "assistant", "\\<s>"), (3, None, "user\n[INST]", "q"), (3, 0, "assistant", "é日\\" * 3000),
        (3, 1, "assistant", ""), (4, 0, "system", "be brief"), *[(4, i, ["assistant", "user"][i % 2], "word " * 200) for i in range(1, 9)],
    ]
    df = with_clashes(spark.createDataFrame(rows, SCHEMA), "window", "formatted", "n_turns")
    got = {r["conv_id"]: r for r in read_windows(format_windows(df, budget=300)).collect()}
    want = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        want[conv] = (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert {k: tuple(r)[1:5] for k, r in got.items()} == want
    assert got[4]["n_windows"] > 2, json.dumps({str(k): r.asDict() for k, r in got.items()})


def test_no_conversations(spark):
    assert read_windows(format_windows(spark.createDataFrame([], SCHEMA))).count() == 0
