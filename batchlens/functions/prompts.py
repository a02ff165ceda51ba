"""Prompt templates as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The literal text of the templates, blanks and newlines included.
LLAMA_OPEN = "<s>[INST] <<SYS>>\n"
LLAMA_MIDDLE = "\n<</SYS>>\n\n"
LLAMA_CLOSE = " [/INST]"
INSTRUCTION_OPEN = "[INST] "
INSTRUCTION_CLOSE = " [/INST]"
SEQUENCE_OPEN = "<s>"
SEQUENCE_CLOSE = "</s>"
CHATML_SYSTEM = "\n<|im_start|>system \n"
CHATML_USER = "\n<|im_end|> \n<|im_start|>user \n"
CHATML_ASSISTANT = "\n<|im_end|> \n<|im_start|>assistant \n"


def llama(system: Column, user: Column) -> Column:
    """System and user text; the opening ``<s>`` stays unclosed."""
    return F.concat(F.lit(LLAMA_OPEN), system, F.lit(LLAMA_MIDDLE), user, F.lit(LLAMA_CLOSE))


def mistral(user: Column) -> Column:
    """A single instruction."""
    return F.concat(F.lit(INSTRUCTION_OPEN), user, F.lit(INSTRUCTION_CLOSE))


def chatml(system: Column, user: Column) -> Column:
    return F.concat(
        F.lit(CHATML_SYSTEM), system, F.lit(CHATML_USER), user, F.lit(CHATML_ASSISTANT)
    )


def chat_piece(role: Column, text: Column, before: Column, after: Column) -> Column:
    """One message of a multi-turn instruction prompt.

    The pieces of a conversation, put end to end, are
    ``<s>[INST] ask [/INST] answer</s>[INST] ask again [/INST]``. The template
    knows no system role, so a system text opens the instruction that follows
    it, with a blank line between; it stands alone where an answer or nothing
    follows. ``before`` and ``after`` are structs with the ``role`` of the
    neighbouring messages, NULL where there is none; a NULL role is a user's.
    """
    system, assistant = F.lit("system"), F.lit("assistant")
    text = F.coalesce(text, F.lit(""))
    opened = F.coalesce(before["role"] == system, F.lit(False))
    goes_on = after.isNotNull() & ~F.coalesce(after["role"] == assistant, F.lit(False))
    begin = F.when(before.isNull(), F.lit(SEQUENCE_OPEN)).otherwise(F.lit(""))
    instruction = F.when(opened, F.lit("")).otherwise(F.lit(INSTRUCTION_OPEN))
    after_system = F.when(goes_on, F.lit("\n\n")).otherwise(F.lit(INSTRUCTION_CLOSE))
    return F.concat(
        begin,
        F.when(role == assistant, F.concat(F.lit(" "), text, F.lit(SEQUENCE_CLOSE)))
        .when(role == system, F.concat(instruction, text, after_system))
        .otherwise(F.concat(instruction, text, F.lit(INSTRUCTION_CLOSE))),
    )
