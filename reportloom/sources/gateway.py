"""Clients of remote models for ``extract.ask``, and tool calls, over HTTP.

A client is made once for each partition and lives on its worker. Whatever sends a request is a parameter, so other
transports and tests bring their own. Addresses, tokens and header names are parameters too; none is built in.
"""

from __future__ import annotations

import json
import os
import urllib.error
import urllib.request
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame

#: Takes url, payload, headers and seconds; returns the status and the lines of the body.
Send = Callable[[str, dict, dict[str, str], float], tuple[int, Iterable[str]]]


def read_prompt(path: str) -> str:
    """A prompt's text; FileNotFoundError without the file."""
    return Path(path).read_text(encoding="utf-8")


def token(given: str | None, *variables: str) -> str:
    """The token given, or else that of the first environment variable set; ValueError without any."""
    found = next(filter(None, (given, *map(os.environ.get, variables))), None)
    if not found:
        raise ValueError(f"a token is needed: pass one or set one of {', '.join(variables) or 'the variables named'}")
    return found


def post(url: str, payload: dict, headers: dict[str, str], timeout: float) -> tuple[int, Iterable[str]]:
    """One request; the body of a good answer is read line by line, as it comes."""
    body = urllib.request.Request(url, json.dumps(payload).encode(), {**headers, "Content-Type": "application/json"})
    try:
        answer = urllib.request.urlopen(body, timeout=timeout)
    except urllib.error.HTTPError as e:
        with e:
            return e.code, [e.read().decode("utf-8", "replace")]

    def lines() -> Iterator[str]:
        with answer:
            for line in answer:
                yield line.decode("utf-8")

    return answer.status, lines()


def good(status: int, lines: Iterable[str]) -> Iterable[str]:
    if status >= 400:
        raise RuntimeError(f"HTTP {status}: {''.join(lines)[:200]}")
    return lines


def streamed(lines: Iterable[str]) -> dict:
    """The response that an event stream adds up to.

    A completed event holds the response; a failed one raises. A stream that ends before gives the text so far, with the
    status created, or unknown without any created event. Other lines and data that are no JSON object are skipped.
    """
    text, made, status = [], None, "unknown"
    for line in lines:
        line = line.strip()
        if not line.startswith("data: "):
            continue
        if line[6:] == "[DONE]":
            break
        try:
            event = json.loads(line[6:])
        except json.JSONDecodeError:
            continue
        match event:
            case {"type": "response.created"}:
                made, status = event.get("response", {}).get("id"), "created"
            case {"type": "response.output_text.delta"}:
                text.append(event.get("delta", ""))
            case {"type": "response.completed"}:
                return event.get("response", {})
            case {"type": "response.failed"}:
                raise RuntimeError(f"response failed: {event}")
    return {"id": made, "status": status, "output_text": "".join(text)}


@dataclass(frozen=True)
class Responses:
    """Makes clients of an agent gateway; an answer is the response's JSON, for ``extract.response_text``.

    ``header`` begins the names of the headers for agent, session and model. A session's requests share their context.
    """

    url: str
    token: str
    agent: str
    header: str
    model: str | None = None
    #: What the payload names when no model is asked for.
    default_model: str = "default"
    instructions: str | None = None
    max_output_tokens: int | None = None
    stream: bool = False
    timeout: float = 120
    send: Send = post

    def request(self, message: str, session: str | None = None) -> tuple[dict, dict[str, str]]:
        payload = {"model": self.model or self.default_model, "input": message}
        more = {"instructions": self.instructions, "max_output_tokens": self.max_output_tokens, "stream": self.stream}
        named = {"agent-id": self.agent, "session-key": session, "model": self.model}
        headers = {f"{self.header}-{k}": v for k, v in named.items() if v}
        return payload | {k: v for k, v in more.items() if v}, {"Authorization": f"Bearer {self.token}", **headers}

    def __call__(self) -> Callable[..., str]:
        def call(message: str, session: str | None = None) -> str:
            lines = good(*self.send(f"{self.url}/v1/responses", *self.request(message, session), self.timeout))
            return json.dumps(streamed(lines), ensure_ascii=False) if self.stream else "".join(lines)

        return call


@dataclass(frozen=True)
class Chat:
    """Makes clients of a local chat server; ``schema``, a JSON schema, binds the form of its answers."""

    url: str
    model: str
    schema: dict | None = None
    context: int = 8192
    timeout: float = 600
    send: Send = post

    def __call__(self) -> Callable[[str], str]:
        payload = {"model": self.model, "stream": False, "options": {"temperature": 0.0, "num_ctx": self.context}}
        payload |= {"format": self.schema} if self.schema else {}

        def call(message: str) -> str:
            lines = good(*self.send(f"{self.url}/api/chat", payload | {"messages": [{"role": "user", "content": message}]}, {}, self.timeout))
            return json.loads("".join(lines))["message"]["content"]

        return call


def invoke(rows: DataFrame, url: str, bearer: str, timeout: float = 120, send: Send = post) -> DataFrame:
    """(keys, ok, result, error_type, error) for rows (keys, tool, args, action, session): one tool call each, failures as rows.

    args is JSON text, result too. args, action and session may be absent or null. A tool that isn't there has the error type tool_not_found.
    """
    parts = [c for c in ("tool", "args", "action", "session") if c in rows.columns]
    keys = [f for f in rows.schema.fields if f.name not in parts]

    def one(tool: str, args: str | None = None, action: str | None = None, session: str | None = None) -> tuple:
        try:
            payload = {"tool": tool, "args": args and json.loads(args), "action": action, "sessionKey": session}
            status, lines = send(f"{url}/tools/invoke", {k: v for k, v in payload.items() if v}, {"Authorization": f"Bearer {bearer}"}, timeout)
            if status == 404:
                return False, None, "tool_not_found", f"Tool '{tool}' not found or not allowed"
            got = json.loads("".join(good(status, lines)))
        except Exception as e:  # noqa: BLE001  the row says what failed
            return False, None, type(e).__name__, str(e)
        error = got.get("error") or {}
        result = json.dumps(got["result"], ensure_ascii=False) if "result" in got else None
        return bool(got.get("ok")), result, error.get("type"), error.get("message")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            asked = b[parts].astype(object).where(b[parts].notna(), None)
            out = [one(**r) for r in asked.to_dict("records")]
            b = b[[f.name for f in keys]].copy()
            for k, name in enumerate(("ok", "result", "error_type", "error")):
                b[name] = [x[k] for x in out]
            yield b

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys)
    return rows.mapInPandas(run, f"{schema}, ok boolean, result string, error_type string, error string")
