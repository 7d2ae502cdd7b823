"""Selection by a model behind a chat endpoint: prompts, requests under a shared budget with a journal, rounds of retries.

The model sees a text's units by id and answers with ids, so that it can't invent text. It is asked once for each different text.
Prompts are columns and answers are read as columns (answers.py); Python workers only send requests. Whatever
goes wrong comes back as data in `error`, and the run falls back on rules.
"""

from __future__ import annotations

import hashlib
import json
import os
import threading
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from juriflow.functions.constants import CATEGORIES
from juriflow.operators import answers
from juriflow.sources.storage import located

# Response modes by falling strictness.
MODES = ("json_schema", "json_object", "plain")
SYSTEM = (
    "Você aponta, numa decisão dividida em unidades numeradas, o que alguém tem de cumprir ou o que foi decidido agora. "
    "Responda com os IDs das unidades, nunca com o texto delas, e apenas com IDs que estão na lista. "
    "Fica de fora o que as partes pedem ou alegam, o que já aconteceu no processo, o que vem de outros processos e o que só serve de fecho ou assinatura. "
    "Uma ordem que continua numa lista vai junto com os itens da lista; a categoria 'tutela' é só para providências de urgência ou provisórias. "
    "Na dúvida, não aponte. No máximo {most} seleções; responda com JSON e mais nada: {{\"selected\": [...]}}."
)
RETRY = 'A resposta anterior não pôde ser lida. Responda só com JSON: {"selected":[{"unit_ids":["U0001"],"category":"...","priority":1,"reason":"..."}]}, com IDs da lista.'


def answer_schema(most: int) -> dict:
    """The response_format of a strict answer."""
    item = {
        "type": "object", "additionalProperties": False, "required": ["unit_ids", "category", "priority", "reason"],
        "properties": {
            "unit_ids": {"type": "array", "minItems": 1, "items": {"type": "string"}}, "category": {"type": "string", "enum": list(CATEGORIES)},
            "priority": {"type": "integer", "minimum": 1, "maximum": 4}, "reason": {"type": "string"},
        },
    }
    schema = {"type": "object", "additionalProperties": False, "required": ["selected"], "properties": {"selected": {"type": "array", "maxItems": most, "items": item}}}
    return {"type": "json_schema", "json_schema": {"name": "unit_selection", "strict": True, "schema": schema}}


def prompt(most: int) -> Column:
    """The messages of the first request about a text, as JSON: what is known of it, and its visible units by id."""
    known = [F.col(c) for c in ("processo", "classe", "orgao_julgador", "expediente", "assunto", "secao_subsecao", "nucleo")]
    routing = F.struct("class_family", "region_key", "orgao_key", "route_key", "specialist").alias("routing")
    rule = F.when(F.coalesce("rule_id", F.lit("")) != "", F.struct("rule_id", F.col("rule_label").alias("label"))).alias("regra_previa")
    visible = F.filter("units", lambda u: u["rejected"].isNull())
    lines = F.array_join(F.transform(visible, lambda u: F.concat(F.lit("["), u["unit_id"], F.lit("] ("), u["section"], F.lit(") "), u["text"])), "\n")
    example = F.lit('{"selected": [{"unit_ids": ["U0001"], "category": "uma categoria permitida", "priority": 1, "reason": "curto"}]}')
    user = F.to_json(
        F.struct(
            F.struct(*known, routing, rule).alias("contexto"), F.array(*map(F.lit, CATEGORIES)).alias("categorias_permitidas"),
            F.coalesce(lines, F.lit("")).alias("unidades"), example.alias("formato"),
        ),
        {"ignoreNullFields": "false"},
    )
    message = [F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in (("system", F.lit(SYSTEM.format(most=most))), ("user", user))]
    return F.to_json(F.array(*message))


#: post(body) -> (HTTP status, response text); raises OSError where no answer comes.
Post = Callable[[dict], tuple[int, str]]


@dataclass
class Endpoint:
    """A chat endpoint; its settings are read from the environment where the run is planned."""

    base: str = field(default_factory=lambda: os.getenv("JURIFLOW_LLM_BASE_URL", "http://127.0.0.1:8081").rstrip("/"))
    model: str = field(default_factory=lambda: os.getenv("JURIFLOW_LLM_MODEL", "Qwen3.5-9B"))
    timeout: int = field(default_factory=lambda: int(os.getenv("JURIFLOW_LLM_TIMEOUT", "180")))
    retries: int = field(default_factory=lambda: max(0, int(os.getenv("JURIFLOW_LLM_RETRIES", "1"))))

    def post(self, body: dict) -> tuple[int, str]:
        data = json.dumps(body).encode()
        request = urllib.request.Request(f"{self.base}/v1/chat/completions", data, {"Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as reply:
                return reply.status, reply.read().decode()
        except urllib.error.HTTPError as e:
            return e.code, e.read().decode(errors="replace")


def send(post: Post, body: dict, most: int) -> tuple[str, str]:
    """(answer, mode): the strictest response format that the server takes."""
    last: Exception = RuntimeError("no request was sent")
    for mode in MODES:
        extra = {"json_schema": {"response_format": answer_schema(most)}, "json_object": {"response_format": {"type": "json_object"}}, "plain": {}}[mode]
        try:
            status, text = post(body | extra)
            if status >= 400:
                raise OSError(f"HTTP {status} in mode {mode}")
        except OSError as e:
            last = e
            continue
        return json.loads(text)["choices"][0]["message"]["content"], mode
    raise last


class Budget:
    """Moments for requests, per_second of them a second, whichever thread asks."""

    def __init__(self, per_second: float | None):
        self.gap, self.next, self.lock = (1 / per_second if per_second else 0.0), 0.0, threading.Lock()

    def wait(self) -> None:
        with self.lock:
            at = max(time.monotonic(), self.next)
            self.next = at + self.gap
        time.sleep(max(0.0, at - time.monotonic()))


class Journal:
    """Answers by the digest of their request, a file each, below a folder that all executors share (a path, or a URI that pyarrow knows)."""

    def __init__(self, folder: str):
        self.files, self.root = located(folder)

    def _path(self, digest: str) -> str:
        return f"{self.root}/{digest[:3]}/{digest}.json"

    def get(self, digest: str) -> dict | None:
        try:
            with self.files.open_input_stream(self._path(digest)) as f:
                return json.loads(f.read())
        except FileNotFoundError:
            return None

    def put(self, digest: str, reply: dict) -> None:
        """Written aside and moved into place: an entry is whole or isn't there."""
        path = self._path(digest)
        self.files.create_dir(os.path.dirname(path), recursive=True)
        aside = f"{path}.{uuid.uuid4().hex}"
        with self.files.open_output_stream(aside) as f:
            f.write(json.dumps(reply).encode())
        self.files.move(aside, path)


_REPLY = "decision_sha256 string, answer string, mode string, error string"


def replies(asked: DataFrame, attempt: int, end: Endpoint, make_post: Callable[[], Post], most: int, parallel: int, at_once: int, per_second: float | None, journal: str | None) -> DataFrame:
    """_REPLY for each row of asked (decision_sha256, prompt): at most at_once requests of each of `parallel` tasks at a time, per_second of all tasks together.

    A request whose answer is in the journal isn't sent: a task that is run again, or a run that is started again, goes on where it was lost.
    """

    def sent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        post, budget = make_post(), Budget(per_second / parallel if per_second else None)
        book = Journal(journal) if journal else None

        def one(key: str, text: str) -> tuple:
            digest = hashlib.sha256(f"{end.model}\n{most}\n{attempt}\n{text}".encode()).hexdigest()
            if book and (had := book.get(digest)):
                return key, had["answer"], had["mode"], None
            told = json.loads(text) + [{"role": "user", "content": RETRY}] * (attempt > 1)
            body = {"model": end.model, "messages": told, "temperature": 0.0, "top_p": 0.9, "max_tokens": 900}
            try:
                budget.wait()
                answer, mode = send(post, body, most)
            except Exception as e:  # whatever a server does is data
                return key, None, None, repr(e)
            if book:
                book.put(digest, {"answer": answer, "mode": mode})
            return key, answer, mode, None

        with ThreadPoolExecutor(at_once) as pool:
            for batch in batches:
                yield pd.DataFrame(list(pool.map(one, batch["decision_sha256"], batch["prompt"])), columns=["decision_sha256", "answer", "mode", "error"])

    return asked.select("decision_sha256", "prompt").repartition(parallel, "decision_sha256").mapInPandas(sent, _REPLY)


def _kept(answers: DataFrame, folder: str | None) -> DataFrame:
    """answers, written out once: to folder, or to the session's checkpoint folder; persisted only where neither is given."""
    spark = answers.sparkSession
    if folder:
        path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}"
        answers.write.parquet(path)
        return spark.read.schema(answers.schema).parquet(path)
    return answers.checkpoint() if spark.sparkContext.getCheckpointDir() else answers.persist()


def teacher(
    make_post: Callable[[], Post] | None = None, endpoint: Endpoint | None = None, parallel: int = 1, folder: str | None = None, at_once: int = 1, per_second: float | None = None
):
    """teacher(lists, most) for plans.extract.run: asks once for each row of lists, and again, up to the endpoint's retries, for those whose answer can't be read.

    Each round asks for all that is left (replies()), reads the answers as columns and is written out (below folder, which all executors must share,
    or as a checkpoint), so that neither a later use of it nor a lost executor asks again. With a folder there is a journal of answers, too.
    """
    end = endpoint or Endpoint()
    make_post = make_post or (lambda: end.post)

    def asked(lists: DataFrame, most: int) -> DataFrame:
        texts = _kept(lists.select("decision_sha256", "units", prompt(most).alias("prompt")), folder)
        left, parts = texts, []
        journal = f"{folder.rstrip('/')}/journal" if folder else None
        for attempt in range(1, end.retries + 2):
            told = _kept(replies(left, attempt, end, make_post, most, parallel, at_once, per_second, journal), folder)
            met = left.select("decision_sha256", "units").join(told.withColumnRenamed("error", "_lost"), "decision_sha256")
            read = answers.read(met, most).withColumn("error", F.coalesce("_lost", "error"))
            status = F.lit("RETRY_OK") if attempt > 1 else F.when(F.size("selected") > 0, "OK").otherwise("EMPTY_VALID")
            status = F.when(F.col("error").isNull(), status).alias("teacher_status")
            none = F.array().cast(answers.SELECTED)
            found = read.select(
                "decision_sha256", F.when(F.col("error").isNull(), F.col("selected")).otherwise(none).alias("selected"), status, F.lit(attempt).alias("teacher_attempts"),
                F.when(F.col("error").isNull(), F.col("mode")).otherwise("fallback").alias("teacher_response_mode"), F.coalesce("note", F.lit("")).alias("note"), "error",
            )
            found = _kept(found, folder)
            last = attempt > end.retries or found.where("error IS NOT NULL").limit(1).count() == 0
            parts.append(found if last else found.where("error IS NULL"))
            if last:
                break
            left = texts.join(found.where("error IS NOT NULL").select("decision_sha256"), "decision_sha256", "left_semi")
        out = parts[0]
        for more in parts[1:]:
            out = out.unionByName(more)
        return out

    return asked
