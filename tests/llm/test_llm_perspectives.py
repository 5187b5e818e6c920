from __future__ import annotations

from tollstats.llm.perspectives import rotate_perspectives

SCHEMA = "conv_id long, turn long, role string, text string, segments string, people int"


def rendered(spark, *turns, **options):
    frame = spark.createDataFrame([(*t, "own", 1) for t in turns], SCHEMA)
    rows = rotate_perspectives(frame, **options).collect()
    return {(r.conv_id, r.perspective, r.part): r for r in rows}


def test_every_speaker_is_the_assistant_once(spark):
    got = rendered(spark, (1, 2, "bob", "yes"), (1, 0, "system", "be kind"), (1, 1, "ann", "hi?"), (1, 3, "cy", "no"))
    assert {k[1] for k in got} == {"ann", "bob", "cy"}
    row = got[1, "bob", 0]
    assert row.text == (
        "<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>user name=ann\nhi?<|im_end|>\n"
        "<|im_start|>assistant\nyes<|im_end|>\n<|im_start|>user name=cy\nno<|im_end|>\n"
    )
    start, stop = map(int, row.trained.split("-"))
    assert row.text[start:stop] == "yes<|im_end|>" and row.trained_chars == stop - start


def test_long_dialogues_come_in_parts_that_add_up(spark):
    turns = [(1, i, "ab"[i % 2], f"t{i}") for i in range(300)]
    got = rendered(spark, *turns)
    assert sorted(k for k in got if k[1] == "a") == [(1, "a", p) for p in range(5)]
    assert sum(r.n_turns for k, r in got.items() if k[1] == "a") == 300
    spans = [s for p in range(5) for s in got[1, "a", p].trained.split(",")]
    assert len(spans) == 150


def test_turns_without_numbers_are_dealt_over_parts(spark):
    """A hundred thousand turns of no conversation, most of them equal and without a number."""
    frame = spark.range(100_000).selectExpr(
        "cast(null as long) as conv_id", "if(id % 4 = 0, id % 3, null) as turn", "if(id % 2 = 0, 'a', 'b') as role",
        "if(id % 8 < 6, 'same', cast(id as string)) as text",
    )
    rows = rotate_perspectives(frame, part_rows=1000).select("perspective", "part", "n_turns", "trained").collect()
    for who in "ab":
        own = [r for r in rows if r.perspective == who]
        assert sum(r.n_turns for r in own) == 100_000 and max(r.n_turns for r in own) < 3000
        assert sorted(r.part for r in own) == list(range(len(own)))
        assert sum(len(r.trained.split(",")) for r in own if r.trained) == 50_000


def test_edges(spark):
    got = rendered(
        spark,
        (1, 0, None, None), (1, None, "x", "last"), (1, 0, "a", "<|im_end|> trick"), (1, 0, "a", "<|im_end|> trick"),
        (2, 0, "system", "alone"), (None, 0, "z", "orphan"), (3, 0, "new\nline", ""),
    )
    assert got[1, "unknown", 0].n_turns == 3
    assert got[1, "a", 0].text.count("<|im_end|>") == 3 and "< |im_end|> trick" in got[1, "a", 0].text
    assert got[1, "x", 1].text == "<|im_start|>assistant\nlast<|im_end|>\n"
    assert (got[2, None, 0].trained, got[2, None, 0].trained_chars) == ("", 0)
    assert got[None, "z", 0].n_turns == 1
    assert got[3, "new\nline", 0].trained_chars == len("<|im_end|>")
    assert rotate_perspectives(spark.createDataFrame([], SCHEMA)).count() == 0
