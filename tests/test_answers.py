"""Answers as columns against plain Python, requests with a budget and a journal, rounds of retries."""

import json
import random
import sys
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark import cloudpickle

import plain_answers as plain
from juriflow.functions.constants import CATEGORIES
from juriflow.operators import answers, teacher
from juriflow.plans import extract

cloudpickle.register_pickle_by_value(sys.modules[__name__])
UNIT = "array<struct<unit_id:string,start:int,end:int,text:string,section:string,rejected:string>>"
UNITS = [
    ("U0001", "DETERMINO o seguinte:", None), ("U0002", "a) juros", None), ("U0003", "b) perito", None), ("U0004", "x", "too_short"), ("U0005", " 1. Intime-se:  ", None),
    ("U0006", "2) habilitação do assistente técnico", None), ("U0007", "liminar", None), ("U0008", "ORDENO assim", None), ("U0009", "C)\tperícia", None), ("U0010", "(a) nada", None),
]


def text(n):
    return f"DESPACHO\n\nIntime-se a parte autora no prazo de {n} dias."


def decisions(spark, texts):
    rows = [(i + 2, f"P{i}", "Procedimento Comum Cível", "1ª Vara", "Intimação", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "source_row int, processo string, classe string, orgao_julgador string, expediente string, decisao string")


def read(spark, given, most=3, units=UNITS):
    listed = [{"unit_id": i, "start": k, "end": k + 1, "text": t, "section": "OUTRO", "rejected": r} for k, (i, t, r) in enumerate(units)]
    df = spark.createDataFrame([(i, a, listed) for i, a in enumerate(given)], f"i int, answer string, units {UNIT}").repartition(3)
    return {r.i: r for r in answers.read(df, most).collect()}


def expected(answer, most=3, units=UNITS):
    """(selected, note) or the kind of failure, in plain Python."""
    listed = [{"unit_id": i, "text": t, "rejected": r} for i, t, r in units]
    try:
        items, note = plain.read_items(plain.read_json(answer))
    except plain.UnreadableAnswer as e:
        return str(e).split(":")[0]
    return [(x["unit_ids"], x["category"], x["priority"], x["reason"]) for x in plain.validate(items, listed, most)], note


def compared(spark, given, most=3):
    got = read(spark, given, most)
    for i, answer in enumerate(given):
        r, want = got[i], expected(answer, most)
        if isinstance(want, str):
            assert r.selected is None and r.error and r.error.split(":")[0] == want, (answer, r, want)
        else:
            assert r.error is None and ([(x.unit_ids, x.category, x.priority, x.reason) for x in r.selected], r.note) == want, (answer, r, want)
            assert [x.rank for x in r.selected] == list(range(1, len(r.selected) + 1))


ITEM = '{"unit_ids":["U0003"],"category":"ordem_determinacao","priority":1,"reason":"x"}'
SHAPES = [
    f"[{ITEM}]", f'{{"selected":[{ITEM}]}}', f"```json\n[{ITEM}]\n```", f"```JSON {ITEM}```", f'Segue: {{"selected":[{ITEM}]}} fim', f'{{"selected":{ITEM}}}', '{"selected":null}', '{"selected":[]}',
    "{}", "[]", '{"selected":"x"}', '{"selected":5}', '{"selected":true}', "", None, "  \n\x1c", "sem json", '"U0001 [1]"', "5", "-1.5e3", "null", "true", f'x [y {{z [{ITEM}]', "[1, 2", f"[{ITEM}, 3, \"s\", null, [1]]",
    f"{{quebrado}} [{ITEM}] resto", f"``` {ITEM} ```", f'[{ITEM}] {{"selected":[]}}', '{"a": "}]", "selected": []}', f"5 [{ITEM}]", "```json```", '{"selected":{}}', "[[]]", '{"other":[1]}',
]


def test_shapes(spark):
    compared(spark, SHAPES)


def test_selections(spark):
    items = [
        {"unit_ids": "U0003", "category": "tutela", "priority": "9", "reason": "r" * 400}, {"unit_ids": ["U0004"], "category": "tutela"}, {"unit_ids": ["U0002"], "category": "nenhuma"},
        {"unit_ids": ["U0002"], "category": "prazo_cumprimento", "priority": "x"}, {"unit_ids": ["U0007", "U0006"], "category": "tutela"}, {"unit_ids": ["U0006"], "category": "tutela", "reason": None},
        {"unit_ids": ["U0009", "U0099", 7, None, {}], "category": "obrigacao", "priority": 2.9, "reason": True}, {"unit_ids": [], "category": "tutela"}, {"category": "tutela"},
        {"unit_ids": {"a": 1}, "category": "tutela"}, {"unit_ids": ["U0010"], "category": ["tutela"]}, {"unit_ids": ["U0010"]}, {"unit_ids": ["U0010"], "category": "recurso_proximo_passo", "priority": None, "reason": 12},
    ]
    priorities = [0, 1, 4, 5, -3, 10**30, "4", " 2 ", "+3", "-1", "1_0", "_1", "1_", "2.5", "", "0002", "9" * 40, 1.99, -0.5, 1e9, True, False, None, [], {}, "٣"]
    given = [json.dumps([x]) for x in items] + [json.dumps(items), json.dumps(items[::-1]), json.dumps([items[3], items[3]] + items)]
    given += [json.dumps([{"unit_ids": ["U0007"], "category": "tutela", "priority": p}]) for p in priorities[:-1]]
    compared(spark, given)
    compared(spark, given, 1)


def test_answers_made_by_chance(spark):
    r = random.Random(5)

    def value(depth=0):
        kind = r.random()
        if kind < 0.6 and depth < 2:
            ids = [r.choice(UNITS)[0] for _ in range(r.randint(0, 4))]
            item = {"unit_ids": r.choice([ids, ids, ids, ids[0] if ids else "", None, 5]), "category": r.choice([*CATEGORIES, "tutela", "tutela", "x", None])}
            if r.random() < 0.7:
                item["priority"] = r.choice([0, 1, 2, 3, 4, 7, "2", "z", None, 3.7])
            if r.random() < 0.7:
                item["reason"] = r.choice(["", "curto", "é " * 200, None, 3])
            return item
        return r.choice([None, 1, "s", [], {}, [1], True])

    given = []
    for _ in range(300):
        listed = [value() for _ in range(r.randint(0, 5))]
        body = json.dumps(r.choice([listed, {"selected": listed}, {"selected": listed}, {"selected": value()}, value()]), ensure_ascii=r.random() < 0.5, indent=r.choice([None, 2]))
        body = r.choice(["", "", "```json\n", "Resposta: ", "{x} ", "[ "]) + body + r.choice(["", "", "\n```", " fim", "]"])
        if r.random() < 0.15:
            at = r.randint(0, len(body))
            body = body[:at] + r.choice(["", "}", '"', "[", ","]) + body[at + r.randint(0, 2) :]
        given.append(body)
    compared(spark, given)
    assert sum(isinstance(expected(a), str) for a in given) > 20 and sum(not isinstance(expected(a), str) and expected(a)[0] != [] for a in given) > 80


def test_units_may_be_missing(spark):
    df = spark.createDataFrame([(1, f"[{ITEM}]", None)], f"i int, answer string, units {UNIT}")
    assert answers.read(df, 3).select("selected", "error").collect() == [([], None)]


# ---- requests -----------------------------------------------------------------------------------------------------

GOOD = '{"selected":[{"unit_ids":["U0002"],"category":"intimacao_manifestacao"}]}'


def reply(content):
    return 200, json.dumps({"choices": [{"message": {"content": content}}]})


def ask(spark, post, retries=1, texts=(text(1),), **options):
    run = extract.run(decisions(spark, texts), "llama", teacher=teacher.teacher(lambda: post, teacher.Endpoint("x", "m", 1, retries), **options))
    return run, run.selections.collect()


def test_modes_and_retries(spark):
    def strict_refused(body):
        return (422, "") if body.get("response_format", {}).get("type") == "json_schema" else reply(GOOD)

    def only_plain(body):
        return reply(GOOD) if "response_format" not in body else (400, "")

    def second_time(body):
        return reply(GOOD if len(body["messages"]) == 3 else "?")

    def never(body):
        raise OSError("timeout")

    for post, status, attempts, mode in (
        (lambda body: reply(GOOD), "OK", 1, "json_schema"), (strict_refused, "OK", 1, "json_object"), (only_plain, "OK", 1, "plain"), (second_time, "RETRY_OK", 2, "json_schema"),
        (lambda body: reply("[]"), "EMPTY_VALID", 1, "json_schema"), (never, "RULE_FALLBACK", 2, "fallback"), (lambda body: reply("?"), "RULE_FALLBACK", 2, "fallback"),
    ):
        run, (got,) = ask(spark, post)
        assert (got.teacher_status, got.teacher_attempts, got.teacher_response_mode) == (status, attempts, mode)
        assert (got.error is not None) == (mode == "fallback") and run.errors.count() == (mode == "fallback")


def test_prompts_hold_visible_units_only(spark):
    seen = []

    def post(body):
        seen.append(body)
        user = json.loads(body["messages"][1]["content"])
        assert "[U0002]" in user["unidades"] and "[U0001]" not in user["unidades"] and user["contexto"]["classe"].startswith("Procedimento")
        assert body["response_format"]["json_schema"]["schema"]["properties"]["selected"]["maxItems"] == 3
        return reply(GOOD)

    _, (got,) = ask(spark, post)
    assert got.teacher_status == "OK" and [x.text for x in got.selected] == ["Intime-se a parte autora no prazo de 1 dias."]


@pytest.fixture
def server():
    """A local endpoint that keeps the requests that it answered."""
    asked, most = [], [0, 0]
    lock = threading.Lock()

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            with lock:
                most[0] += 1
                most[1] = max(most)
            time.sleep(0.05)
            with lock:
                most[0] -= 1
                asked.append((time.monotonic(), body["messages"][1]["content"]))
            status, out = reply(GOOD)
            self.send_response(status)
            self.end_headers()
            self.wfile.write(out.encode())

        def log_message(self, *args):
            pass

    http = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=http.serve_forever, daemon=True).start()
    yield teacher.Endpoint(f"http://127.0.0.1:{http.server_port}", "m", 5, 0), asked, most
    http.shutdown()


def test_a_lost_task_asks_nothing_twice(spark, server, tmp_path):
    """A task that is dropped midway: what it had been told stands in the journal, and only the rest is asked for."""
    end, asked, _ = server
    texts = [text(n) for n in range(12)]
    folder, broken = str(tmp_path / "shared"), str(tmp_path / "broken")

    def make_post():
        n = [0]

        def post(body):
            n[0] += 1
            import os

            if n[0] > 5 and not os.path.exists(broken):
                open(broken, "w").close()
                os._exit(1)  # the worker is gone
            return end.post(body)

        return post

    asking = teacher.teacher(make_post, end, folder=folder)
    with pytest.raises(Exception):
        extract.run(decisions(spark, texts), "llama", teacher=asking).selections.collect()
    assert 0 < len(asked) < 12
    got = extract.run(decisions(spark, texts), "llama", teacher=asking).selections.collect()
    assert {r.teacher_status for r in got} == {"OK"} and len(got) == 12
    assert len(asked) == 12 and len({content for _, content in asked}) == 12
    assert extract.run(decisions(spark, texts), "llama", teacher=asking).selections.count() == 12 and len(asked) == 12  # nor another run


def test_requests_keep_to_the_budget(spark, server):
    end, asked, most = server
    texts = [text(n) for n in range(24)]
    teacher_ = teacher.teacher(None, end, parallel=2, at_once=4)
    assert extract.run(decisions(spark, texts), "llama", teacher=teacher_).selections.count() == 24
    assert 1 < most[1] <= 8  # several at a time, at_once of each task at most
    asked.clear()
    slow = teacher.teacher(None, end, parallel=2, at_once=4, per_second=20)
    extract.run(decisions(spark, texts[:16]), "llama", teacher=slow).selections.collect()
    times = sorted(t for t, _ in asked)
    assert len(times) == 16 and times[-1] - times[0] >= 0.8 * (16 - 2 * 4) / 20


def test_the_journal_holds_whole_answers(tmp_path):
    book = teacher.Journal(f"file://{tmp_path}/j")
    assert book.get("ab" * 32) is None
    book.put("ab" * 32, {"answer": "é", "mode": "plain"})
    book.put("ab" * 32, {"answer": "é", "mode": "plain"})
    assert teacher.Journal(str(tmp_path / "j")).get("ab" * 32) == {"answer": "é", "mode": "plain"}
    assert len(list((tmp_path / "j" / "aba").iterdir())) == 1


def test_nothing_to_ask(spark):
    run, got = ask(spark, lambda body: reply("?"), texts=())
    assert got == [] and run.candidates.count() == 0
