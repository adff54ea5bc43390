"""Adapters of outside models.  Their libraries are imported in the process that uses them, and only there."""

from __future__ import annotations

import json
import re
import urllib.request
from collections.abc import Callable
from functools import lru_cache


def span_model(name: str, device: str = "cpu") -> Callable[[], object]:
    """A factory for ner.predict(): each worker loads the span model of that name on the device."""

    def load():
        from gliner import GLiNER

        return GLiNER.from_pretrained(name).to(device)

    return load


@lru_cache(maxsize=1)
def _generator(name: str, device: int | str, local_only: bool):
    from transformers import pipeline

    return pipeline("text-generation", model=name, tokenizer=name, device=device, model_kwargs={"local_files_only": local_only})


def generate(name: str, prompt: str, tokens_out: int, device: int | str = -1, local_only: bool = True) -> str:
    """The continuation that a local text model writes, without sampling."""
    return _generator(name, device, local_only)(prompt, max_new_tokens=tokens_out, do_sample=False, return_full_text=False)[0]["generated_text"]


def first_object(text: str) -> dict | None:
    """The first {...} of a text if it is a JSON object."""
    m = re.search(r"\{.*?\}", text, re.S)
    try:
        found = json.loads(m[0]) if m else None
    except ValueError:
        return None
    return found if isinstance(found, dict) else None


def answer(name: str, prompt: str, tokens_out: int) -> dict | None:
    """The JSON object that a local text model answers with; None without one."""
    return first_object(generate(name, prompt, tokens_out))


class ChatClient:
    """A client for render_cases(): a chat endpoint over HTTP, set by a sources.datasets.WriterConfig.

    Failures raise; the caller repairs or falls back.
    """

    def __init__(self, config, system: str = "", repair: bool = False):
        self.config, self.system = config, system
        self.temperature = config.repair_temperature if repair else config.temperature

    def __call__(self, prompt: str) -> str:
        c = self.config
        messages = ([{"role": "system", "content": self.system}] if self.system else []) + [{"role": "user", "content": prompt}]
        body = {"model": c.model, "messages": messages, "temperature": self.temperature, "top_p": c.top_p, "max_tokens": c.max_tokens}
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {c.key}"} if c.key else {})
        request = urllib.request.Request(f"{c.url.rstrip('/')}/chat/completions", json.dumps(body).encode(), headers)
        with urllib.request.urlopen(request, timeout=c.timeout) as reply:
            said = json.load(reply)
        text = ((said.get("choices") or [{}])[0].get("message", {}).get("content") or "").strip()
        if not text:
            raise ValueError("the model's answer is empty")
        return text
