"""A language model behind an HTTP endpoint that takes chat requests and gives chat completions, on the standard library alone.

An instance is pickled to the executors with its settings; each call opens its own connection. Keys come from the environment of the
process that calls, so none travels in a plan.
"""

from __future__ import annotations

import json
import os
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from typing import Any

#: what is asked for when a task has no prompt of its own
ANY_TASK = "Do the task named {task} on the inputs that follow as JSON. Answer with JSON only."
#: replies that are worth another try: too many requests, and faults of the server
AGAIN = frozenset({408, 429, 500, 502, 503, 504})


class HttpModel:
    """``LanguageModel`` over HTTP: up to ``tries`` requests of ``timeout`` seconds each, with growing pauses."""

    def __init__(self, url: str, model: str, prompts: dict[str, str] | None = None, key_name: str = "MODEL_API_KEY", timeout: float = 60, tries: int = 3, delay: float = 1.0) -> None:
        self.url, self.model, self.prompts, self.key_name = url.rstrip("/"), model, prompts or {}, key_name
        self.timeout, self.tries, self.delay = timeout, tries, delay

    def request(self, task: str, inputs: dict[str, Any], stream: bool = False) -> urllib.request.Request:
        body = {
            "model": self.model,
            "stream": stream,
            "messages": [{"role": "system", "content": self.prompts.get(task, ANY_TASK).replace("{task}", task)}, {"role": "user", "content": json.dumps(inputs, ensure_ascii=False, default=str)}],
        }
        headers = {"Content-Type": "application/json"}
        if key := os.environ.get(self.key_name):
            headers["Authorization"] = f"Bearer {key}"
        return urllib.request.Request(f"{self.url}/chat/completions", json.dumps(body).encode(), headers)

    def _open(self, request: urllib.request.Request):
        for k in range(self.tries):
            try:
                return urllib.request.urlopen(request, timeout=self.timeout)
            except urllib.error.HTTPError as e:
                if e.code not in AGAIN or k + 1 == self.tries:
                    raise OSError(f"the model's server answered {e.code}") from e
            except OSError:
                if k + 1 == self.tries:
                    raise
            time.sleep(self.delay * 2**k)
        raise OSError("no try was allowed")

    def __call__(self, task: str, inputs: dict[str, Any]) -> str:
        with self._open(self.request(task, inputs)) as reply:
            doc = json.load(reply)
        try:
            return doc["choices"][0]["message"]["content"] or ""
        except (KeyError, IndexError, TypeError) as e:
            raise ValueError("the reply holds no completion") from e

    def stream(self, task: str, inputs: dict[str, Any]) -> Iterator[str]:
        """The completion's parts as they come."""
        with self._open(self.request(task, inputs, stream=True)) as reply:
            for line in reply:
                if not line.startswith(b"data:"):
                    continue
                data = line[5:].strip()
                if data == b"[DONE]":
                    return
                for choice in json.loads(data).get("choices", []):
                    if part := (choice.get("delta") or {}).get("content"):
                        yield part
