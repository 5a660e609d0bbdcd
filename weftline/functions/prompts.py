"""Prompts and identifiers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

JSON = {"ignoreNullFields": "false"}
EMPTY_CHAT = "Nothing has been said yet."
SCENARIO_FORMAT = {"type": "json_schema", "name": "scenario", "strict": True, "fields": ["situation", "topic"]}
TURN_FORMAT = {"type": "json_schema", "name": "turn", "strict": True, "fields": ["messages"]}


def lean_persona(persona: Column) -> Column:
    """A persona without what a prompt must not show."""
    return persona.dropFields("username", "model", "id")


def transcript(parts: Column, experience: Column) -> Column:
    """One line for each message, led by its speaker's name; a fixed sentence for an empty chat.

    A sender that is neither persona gets a null name and so drops out of the line's lead; if both
    personas have one id the second's name is used.
    """
    def lines(part: Column) -> Column:
        name = F.when(part["sender"] == experience["persona2"]["id"], experience["persona2"]["name"]).when(part["sender"] == experience["persona1"]["id"], experience["persona1"]["name"])
        return F.transform(part["messages"], lambda m: F.concat_ws(": ", name, m))

    text = F.array_join(F.flatten(F.transform(parts, lines)), "\n")
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(EMPTY_CHAT)).otherwise(text)


def example_block(experiences: Column) -> Column:
    """Numbered reference scenarios for a prompt; empty without any."""
    def one(x: Column, i: Column) -> Column:
        return F.format_string("Reference %d\nFirst: %s\nSecond: %s\nTie: %s\nScene: %s\nSubject: %s", i + 1, F.to_json(lean_persona(x["persona1"]), JSON), F.to_json(lean_persona(x["persona2"]), JSON), x["relationship"], x["situation"], x["topic"])

    return F.coalesce(F.array_join(F.transform(experiences, one), "\n\n"), F.lit(""))


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def scenario_prompt(persona1: Column, persona2: Column, relationship: Column, trigger: Column, examples: Column) -> Column:
    """The messages that ask for a scenario of two personas."""
    body = F.concat_ws("\n\n", F.when(examples != "", examples), F.format_string("First: %s\nSecond: %s\nTie: %s\nSpark: %s", F.to_json(lean_persona(persona1), JSON), F.to_json(lean_persona(persona2), JSON), relationship, trigger))
    return F.array(_message("system", F.lit("Invent one scene in which the two people text each other. Answer in JSON with situation and topic.")), _message("user", body))


def turn_prompt(parts: Column, experience: Column, sender: Column) -> Column:
    """The messages that ask for the next turn of a chat by ``sender`` (a persona): rules, both people, the scene and what was said."""
    scene = F.struct(lean_persona(experience["persona1"]).alias("persona1"), lean_persona(experience["persona2"]).alias("persona2"), *[experience[f].alias(f) for f in ("relationship", "situation", "topic")])
    body = F.format_string(_TURN, sender["name"], F.to_json(scene, JSON), transcript(parts, experience))
    return F.array(_message("system", F.lit(TURN_RULES)), _message("user", body))


TURN_RULES = "You write one turn of a chat between two people. Answer in JSON with messages and nothing else."
_TURN = "Write what %s sends next.\n\nThe people and the scene:\n%s\n\nThe chat so far:\n%s\n\nSend one or a few short messages in that person's style. Media go into tags, and an end tag closes the chat when it has come to its end."


def turn_messages(parts: list[dict], experience: dict, sender: dict) -> list[dict]:
    """As :func:`turn_prompt`, outside a plan, where each turn depends on the model's answer to the last."""
    import json

    lean = lambda p: {k: v for k, v in p.items() if k not in ("username", "model", "id")}
    scene = {"persona1": lean(experience["persona1"]), "persona2": lean(experience["persona2"])} | {f: experience[f] for f in ("relationship", "situation", "topic")}
    names = {p["id"]: p["name"] for p in (experience["persona1"], experience["persona2"])}
    said = "\n".join(f"{names[p['sender']]}: {m}" for p in parts for m in p["messages"]) or EMPTY_CHAT
    return [{"role": "system", "content": TURN_RULES}, {"role": "user", "content": _TURN % (sender["name"], json.dumps(scene, ensure_ascii=False, separators=(",", ":")), said)}]


_TRANSLATE = "Put the text into %s (%s). Keep tags as they are, keep the tone, and give nothing but the translation.\n\n%s"


def translation_prompt(text: Column, name: Column, native_name: Column) -> Column:
    """Asks for a translation of ``text`` alone, tags kept."""
    return F.format_string(_TRANSLATE, name, native_name, text)


def translation_text(text: str, name: str, native_name: str) -> str:
    """As :func:`translation_prompt`, outside a plan."""
    return _TRANSLATE % (name, native_name, text)


def chat_template(messages: list[dict]) -> str:
    """A plain template of a chat prompt, with the turn of the assistant opened at its end."""
    return "".join(f"[{m['role']}]\n{m['content']}\n" for m in messages) + "[assistant]\n"


def chat_id(persona1: Column, persona2: Column, seconds: Column) -> Column:
    return F.concat_ws("_", persona1["id"], persona2["id"], seconds.cast("string"))


def new_id() -> Column:
    """32 hex digits at random; store the rows before using them twice."""
    return F.replace(F.uuid(), F.lit("-"), F.lit(""))


def short_model(model: Column) -> Column:
    """What follows the last slash of a model's name."""
    return F.element_at(F.split(model, "/"), -1)


def short_name(model: str) -> str:
    """As :func:`short_model`, outside a plan."""
    return model.rpartition("/")[2]
