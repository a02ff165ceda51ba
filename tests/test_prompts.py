from pyspark.sql import functions as F

from batchlens.functions import prompts
from batchlens.operators.chat import chat_prompts
from batchlens.sources.synthetic import (
    DEFINE_BRIEFLY,
    SPELL_BRIEFLY,
    WORDS,
    question,
    synthetic_prompts,
)


def render(spark, template, *values):
    return spark.range(1).select(template(*[F.lit(v) for v in values])).first()[0]


def test_templates(spark):
    assert render(spark, prompts.llama, "S", "U") == (
        "<s>[INST] <<SYS>>\nS\n<</SYS>>\n\nU [/INST]"
    )
    assert render(spark, prompts.mistral, "U") == "[INST] U [/INST]"
    assert render(spark, prompts.chatml, "S", "U") == (
        "\n<|im_start|>system \nS\n<|im_end|> \n<|im_start|>user \nU\n<|im_end|> \n"
        "<|im_start|>assistant \n"
    )


def chat(spark, *messages, **bounds):
    data = [(1, i, role, text) for i, (role, text) in enumerate(messages)]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    return [r.prompt for r in chat_prompts(df, **bounds).orderBy("part").collect()]


def test_chat_turns(spark):
    assert chat(spark, ("user", "i"), ("assistant", "a"), ("user", "f")) == [
        "<s>[INST] i [/INST] a</s>[INST] f [/INST]"
    ]


def test_chat_system_goes_before_the_next_instruction(spark):
    assert chat(spark, ("system", "s"), ("user", "i")) == ["<s>[INST] s\n\ni [/INST]"]
    assert chat(spark, ("system", "s"), ("system", "t"), ("user", "i")) == [
        "<s>[INST] s\n\nt\n\ni [/INST]"
    ]
    assert chat(spark, ("user", "i"), ("system", "s")) == ["<s>[INST] i [/INST][INST] s [/INST]"]
    assert chat(spark, ("system", "s"), ("assistant", "a")) == ["<s>[INST] s [/INST] a</s>"]


def test_long_conversation_comes_in_parts(spark):
    talk = [("user" if i % 2 == 0 else "assistant", f"m{i}") for i in range(41)]
    whole = chat(spark, *talk)
    assert len(whole) == 1
    assert chat(spark, *talk, max_rows=5) == whole
    by_chars = chat(spark, *talk, max_chars=30)
    assert len(by_chars) > 9 and "".join(by_chars) == whole[0]
    assert chat(spark, *talk, max_rows=5, max_chars=30) == by_chars


def test_chat_without_a_role_is_not_a_beginning(spark):
    assert chat(spark, ("user", "q"), (None, "x"), ("assistant", "a")) == [
        "<s>[INST] q [/INST][INST] x [/INST] a</s>"
    ]


def test_synthetic_prompts_repeat_and_cover(spark):
    first = synthetic_prompts(spark, 2000).collect()
    assert first == synthetic_prompts(spark, 2000).collect()
    assert synthetic_prompts(spark, 2000, seed=1).collect() != first
    texts = [r.text for r in first]
    for word in WORDS:
        assert any(f"How do you spell '{word}'?[/INST]" in t for t in texts)
        assert any(f"What is the definition of '{word}'?[/INST]" in t for t in texts)
    spelled = sum("spell" in t for t in texts)
    assert 800 < spelled < 1200


def test_synthetic_ids_may_be_huge(spark):
    ids = spark.createDataFrame([(2**62,), (-5,)], "id long")
    texts = ids.select(
        question(F.col("id"), spell=SPELL_BRIEFLY, define=DEFINE_BRIEFLY).alias("t")
    ).collect()
    assert all(r.t.startswith("Answer to my quesiton") for r in texts)
