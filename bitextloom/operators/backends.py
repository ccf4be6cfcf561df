"""Text models behind the enrichment operators.

A backend is a small picklable description. Each task connects for itself and
gets a function from text to translation; errors are raised.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import count
from threading import Lock

from bitextloom.defaults import (
    API_IN_FLIGHT,
    API_MODEL,
    LOCAL_BASE_URL,
    LOCAL_IN_FLIGHT,
    LOCAL_MODEL,
    MAX_COMPLETION_TOKENS,
    TEMPERATURE,
)
from bitextloom.functions.text import prompt_turns

Call = Callable[[str], "str | None"]


@dataclass(frozen=True)
class Backend:
    """Base: `max_in_flight` calls at a time per task, answers of up to `max_tokens`.

    With `waits_out_rate_limits`, a rate-limit error is retried for as long as it
    takes and does not use up tries; otherwise it counts like any error.
    """

    name: str = "backend"
    max_in_flight: int = 1
    waits_out_rate_limits: bool = False
    max_tokens: int = MAX_COMPLETION_TOKENS

    def connect(self) -> Call:
        raise NotImplementedError


@dataclass(frozen=True)
class PrefixBackend(Backend):
    """Deterministic stand-in: puts a marker before the text."""

    name: str = "prefix"
    prefix: str = "[ja] "

    def connect(self) -> Call:
        return lambda text: self.prefix + text


@dataclass(frozen=True)
class FaultyBackend(Backend):
    """Deterministic stand-in that fails on purpose.

    A text that contains a key of `faults` fails that many times before it
    succeeds, with `message`; a negative number fails always.
    """

    name: str = "faulty"
    faults: tuple[tuple[str, int], ...] = ()
    message: str = "model error"
    prefix: str = "[ja] "

    def connect(self) -> Call:
        seen: dict[str, int] = {}
        lock = Lock()

        def call(text: str) -> str:
            for mark, times in self.faults:
                if mark in text:
                    with lock:
                        tries = seen[text] = seen.get(text, 0) + 1
                        if 0 <= times < tries:
                            del seen[text]
                            return self.prefix + text
                    raise RuntimeError(self.message)
            return self.prefix + text

        return call


@dataclass(frozen=True)
class ChatBackend(Backend):
    """A chat-completion service, local (`gpt-oss`) or remote (`openai-api`).

    The client package is imported in the task; the key is read from the
    executor's environment and never enters a column or a plan.
    """

    name: str = "gpt-oss"
    model: str = LOCAL_MODEL
    base_urls: tuple[str, ...] = (LOCAL_BASE_URL,)
    temperature: float | None = TEMPERATURE
    key_variable: str = "OPENAI_API_KEY"
    max_in_flight: int = LOCAL_IN_FLIGHT
    extra: dict = field(default_factory=dict)

    def request(self, text: str) -> dict:
        """Keyword arguments of one call; the two kinds name the completion limit differently."""
        messages = [{"role": role, "content": content} for role, content in prompt_turns(text)]
        request = {"model": self.model, "messages": messages, **self.extra}
        if self.waits_out_rate_limits:
            return {**request, "max_completion_tokens": self.max_tokens}
        return {**request, "temperature": self.temperature, "max_tokens": self.max_tokens}

    def connect(self) -> Call:
        from openai import OpenAI

        key = os.environ.get(self.key_variable, "dummy")
        clients = [OpenAI(api_key=key, **({"base_url": url} if url else {})) for url in self.base_urls]
        turn = count(_task_number())

        def call(text: str) -> str | None:
            client = clients[next(turn) % len(clients)]
            return client.chat.completions.create(**self.request(text)).choices[0].message.content

        return call


def _task_number() -> int:
    """Partition number of the running task, so that tasks start at different servers."""
    from pyspark import TaskContext

    context = TaskContext.get()
    return context.partitionId() if context else 0


def local_chat(urls: tuple[str, ...] = (LOCAL_BASE_URL,), model: str = LOCAL_MODEL, **options) -> ChatBackend:
    """Backend `gpt-oss`: own servers, sampling temperature, limited retries."""
    return ChatBackend(name="gpt-oss", base_urls=urls, model=model, **options)


def api_chat(url: str = "", model: str = API_MODEL, **options) -> ChatBackend:
    """Backend `openai-api`: remote service, waits out rate limits."""
    options = {"max_in_flight": API_IN_FLIGHT, "waits_out_rate_limits": True, **options}
    return ChatBackend(name="openai-api", base_urls=(url,), model=model, temperature=None, **options)
