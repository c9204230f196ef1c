"""External text completion as an operator.

A provider turns a prompt into text. It is made once per task, failures give '', an
answer that holds no JSON is asked for again, and answers are kept by prompt so a
second run calls nothing.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RETRIES = 3
_JSON = re.compile(r"\{.*\}|\[.*\]", re.S)


class Provider(Protocol):
    def complete(self, prompt: str, as_json: bool = False) -> str: ...


class Offline:
    """Answers from a fixed mapping, else with a default; for tests and dry runs."""

    def __init__(self, answers: dict[str, str] | None = None, default: str = "{}"):
        self.answers, self.default = answers or {}, default

    @classmethod
    def empty(cls) -> Offline:
        """Answers nothing, so texts stay as they are."""
        return cls(default="")

    def complete(self, prompt: str, as_json: bool = False) -> str:
        return self.answers.get(prompt, self.default)


class Http:
    """A provider behind one JSON endpoint: posts model, prompt and limits, reads the field ``text``."""

    def __init__(self, url: str, key: str, model: str, most_tokens: int = 4000):
        self.url, self.key, self.model, self.most_tokens = url, key, model, most_tokens

    def complete(self, prompt: str, as_json: bool = False) -> str:
        import urllib.request

        body = {"model": self.model, "prompt": prompt, "max_tokens": self.most_tokens, "json": as_json} | options(self.model, as_json)
        ask = urllib.request.Request(self.url, json.dumps(body).encode(), {"Authorization": f"Bearer {self.key}", "Content-Type": "application/json"})
        with urllib.request.urlopen(ask, timeout=300) as answer:
            return json.loads(answer.read()).get("text") or ""


def factory(settings: dict, environment: dict | None = None) -> Callable[[], Provider]:
    """What makes a provider in a task: the configured endpoint, or the offline one without an address.

    The key comes from the environment variable that ``key_variable`` names.
    """
    url = settings.get("completion_url")
    if not url:
        return Offline
    key = (environment or {}).get(settings.get("key_variable", "COMPLETION_KEY"), "")
    return lambda: Http(url, key, settings.get("engine", ""), settings.get("most_tokens", 4000))


# Parts of model names that take no temperature, and that know no JSON mode.
NO_TEMPERATURE = ("gpt-5-", "o3-", "o4-")
NO_JSON = ("gpt-5-nano-",)
# The clients of a run and the prompt that each one uses.
CLIENTS = {
    "article_ai_client": "article_extraction", "references_ai_client": "references_extraction", "field_completion_ai_client": "field_completion",
    "affiliation_correction_client": "author_affiliation_correction", "text_processing_client": "text_processing",
}


def options(model: str, as_json: bool = False) -> dict:
    """Temperature 0 for models that take one, JSON mode where it is asked for and known."""
    out: dict = {} if any(s in model for s in NO_TEMPERATURE) else {"temperature": 0}
    if as_json and not any(s in model for s in NO_JSON):
        out["response_format"] = {"type": "json_object"}
    return out


def clients(config, make: Callable[[], Provider]) -> dict[str, tuple[Callable[[], Provider], str]]:
    """The named clients of a run: what makes each one's provider, and its prompt from the configuration."""
    return {name: (make, config.prompt(prompt)) for name, prompt in CLIENTS.items()}


def parse(text: str):
    """The JSON value in an answer; ValueError without one."""
    m = _JSON.search(text)
    if not m:
        raise ValueError("no JSON in the answer")
    return json.loads(m.group())


def ask_json(provider: Provider, prompt: str, retries: int = RETRIES) -> tuple[str, int]:
    """(JSON text, calls made); '{}' when no call gave JSON."""
    for n in range(1, retries + 2):
        try:
            answer = provider.complete(prompt, True)
        except Exception:
            answer = ""
        try:
            return json.dumps(parse(answer or ""), ensure_ascii=False), n
        except ValueError:
            continue
    return "{}", retries + 1


def complete(df: DataFrame, prompt: str, make: Callable[[], Provider], as_json: bool = True, known: DataFrame | None = None) -> DataFrame:
    """(prompt, answer, calls) of every distinct prompt of ``df``.

    ``known`` holds (prompt, answer) of earlier runs: those prompts cost no call
    (``calls`` 0). Null and empty prompts get an empty answer without a call.
    """
    wanted = df.select(F.col(prompt).alias("prompt")).distinct()
    if known is not None:
        have = wanted.join(known.select("prompt", "answer"), "prompt").withColumn("calls", F.lit(0))
        wanted = wanted.join(known.select("prompt"), "prompt", "left_anti")

    def run(frames: Iterator[pd.DataFrame]):
        provider = make()
        for pdf in frames:
            rows = []
            for p in pdf["prompt"]:
                if not p:
                    rows.append((p, "", 0))
                elif as_json:
                    rows.append((p, *ask_json(provider, p)))
                else:
                    try:
                        rows.append((p, provider.complete(p) or "", 1))
                    except Exception:
                        rows.append((p, "", 1))
            yield pd.DataFrame(rows, columns=["prompt", "answer", "calls"])

    got = wanted.mapInPandas(run, "prompt string, answer string, calls int")
    return got.unionByName(have) if known is not None else got


AUTHOR = (
    "struct<authorFirstName:string,authorMiddleName:string,authorLastName:string,authorAffiliation:string,authorAffiliationEn:string,"
    "authorCountry:string,authorEmail:string,orcid:string>"
)
ARTICLE = f"struct<language:string,titleOrig:string,titleEn:string,abstractOrig:string,abstractEn:string,keywordsOrig:string,keywordsEn:string,doi:string,authors:array<{AUTHOR}>>"
REFERENCES = "struct<references:array<struct<description:string,doi:string,link:string,accessed:string>>>"
MAPPING = "struct<originalAuthorAffiliation:string,authorAffiliation:string,authorAffiliationEn:string>"


def extract_articles(df: DataFrame, first: str, last: str, make: Callable[[], Provider], prompts: tuple[str, str] = ("", ""), known: DataFrame | None = None) -> DataFrame:
    """``df`` with the struct columns ``article`` and ``refs`` read from the answers about its pages."""
    asked = df.withColumn("_p1", F.concat(F.lit(prompts[0]), F.col(first))).withColumn("_p2", F.concat(F.lit(prompts[1]), F.col(last)))
    both = asked.select(F.explode(F.array("_p1", "_p2")).alias("prompt"))
    answers = complete(both, "prompt", make, True, known)
    a = answers.select(F.col("prompt").alias("_p1"), F.from_json("answer", ARTICLE).alias("article"))
    # items of a list that are no objects are left out
    a = a.withColumn("article", F.col("article").withField("authors", F.filter("article.authors", lambda x: x.isNotNull())))
    b = answers.select(F.col("prompt").alias("_p2"), F.filter(F.from_json("answer", REFERENCES)["references"], lambda x: x.isNotNull()).alias("refs"))
    return asked.join(a, "_p1", "left").join(b, "_p2", "left").drop("_p1", "_p2").withColumn("language", F.lit("pt"))


def complete_rows(df: DataFrame, gate, payload, schema: str, make: Callable[[], Provider], overlay: bool = False, prompt: str = "") -> DataFrame:
    """Rows that the gate picks are replaced by the answer about their payload.

    Fields that the answer leaves out become null, or stay with ``overlay``; an answer
    that is no object, or an empty one, leaves the row as it was.
    """
    asked = df.withColumn("_prompt", F.when(gate, F.concat(F.lit(prompt), payload)))
    answers = complete(asked.where("_prompt is not null"), "_prompt", make)
    usable = answers.where(F.col("answer").startswith("{") & (F.col("answer") != "{}")).select(F.col("prompt").alias("_prompt"), F.from_json("answer", schema).alias("_a"))
    joined = asked.join(usable, "_prompt", "left")
    fields = set(usable.schema["_a"].dataType.names)

    def one(c: str):
        if c not in fields:
            return F.col(c)
        new = F.coalesce(F.col("_a")[c], F.col(c)) if overlay else F.col("_a")[c]
        return F.when(F.col("_a").isNotNull(), new).otherwise(F.col(c)).alias(c)

    return joined.select(*[one(c) for c in df.columns])


def correct_affiliations(chunks: DataFrame, body: str, make: Callable[[], Provider], prompt: str = "") -> DataFrame:
    """Mapping rows of every chunk's answer: a list, one object, or either under 'universidades'."""
    answers = complete(chunks.select(F.concat(F.lit(prompt), F.col(body)).alias("p")), "p", make)
    inner = F.coalesce(F.get_json_object("answer", "$.universidades"), F.col("answer"))
    listed = F.when(inner.startswith("["), inner).otherwise(F.concat(F.lit("["), inner, F.lit("]")))
    rows = answers.select(F.explode(F.from_json(listed, f"array<{MAPPING}>")).alias("m"))
    return rows.select("m.*").where("originalAuthorAffiliation is not null")


def repair_text(df: DataFrame, text: str, flagged, make: Callable[[], Provider], prompt: str = "") -> DataFrame:
    """``df`` with the flagged texts replaced by their repaired form."""
    asked = df.withColumn("_p", F.when(flagged, F.concat(F.lit(prompt), F.col(text))))
    answers = complete(asked.where("_p is not null"), "_p", make, as_json=False).select(F.col("prompt").alias("_p"), "answer")
    better = F.when(F.coalesce("answer", F.lit("")) != "", F.col("answer")).otherwise(F.col(text))
    return asked.join(answers, "_p", "left").withColumn(text, better).drop("_p", "answer")
