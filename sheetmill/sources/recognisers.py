"""Recognisers: OCR, text models and vision models behind one interface, called from iterator UDFs.

A recogniser is made once per Python worker by its factory. Failures become a status beside an empty text, never a lost row.
"""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip

ANSWERS = "pdf_path string, page_index int, crop_ord int, raw string, status string"


class Recogniser(Protocol):
    def read(self, prompt: str, image: bytes | None) -> str: ...


@dataclass(frozen=True)
class Settings:
    """What a run reads from its command line; the model's limits are those of the service."""

    provider: str = "openai"
    base_url: str = ""
    model: str = ""
    api_key: str = ""
    timeout_s: float = 30.0
    max_tokens: int = 256
    system: str = ""
    options: dict = field(default_factory=dict)


def base_url(url: str, provider: str) -> str:
    """With a scheme; for a local server without a trailing version."""
    url = url.strip().rstrip("/")
    url = url if "://" in url else f"http://{url}"
    if provider == "ollama" and url.endswith("/v1"):
        url = url[:-3]
    if not urllib.request.urlparse(url).netloc:
        raise ValueError(f"no host in {url!r}")
    return url


class Recorded:
    """Answers from a dictionary of prompts, for tests and replays."""

    def __init__(self, answers: dict[str, str]) -> None:
        self.answers = answers

    def read(self, prompt: str, image: bytes | None = None) -> str:
        return self.answers[prompt]


class Served:
    """A model behind an HTTP service with a chat interface."""

    def __init__(self, settings: Settings) -> None:
        self.settings = settings

    def read(self, prompt: str, image: bytes | None = None) -> str:
        import base64

        s = self.settings
        local = s.provider == "ollama"
        content: object = prompt
        message: dict = {"role": "user", "content": content}
        if image is not None and local:
            message["images"] = [base64.b64encode(image).decode()]
        elif image is not None:
            shown = {"url": "data:image/png;base64," + base64.b64encode(image).decode()}
            message["content"] = [{"type": "text", "text": prompt}, {"type": "image_url", "image_url": shown}]
        messages = ([{"role": "system", "content": s.system}] if s.system else []) + [message]
        body = {"model": s.model, "messages": messages, "stream": False} | ({} if local else {"max_tokens": s.max_tokens, "temperature": 0}) | s.options
        path = "/api/chat" if local else "/v1/chat/completions"
        request = urllib.request.Request(base_url(s.base_url, s.provider) + path, json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {s.api_key}"})
        with urllib.request.urlopen(request, timeout=s.timeout_s) as reply:
            return answer_text(json.load(reply))


def answer_text(reply: dict) -> str:
    """The text of a service's reply in either of the two known forms."""
    if reply.get("choices"):
        return reply["choices"][0]["message"]["content"] or ""
    return (reply.get("message") or {}).get("content") or ""


def recognise(crops: DataFrame, make: Callable[[], Recogniser]) -> DataFrame:
    """(page, crop_ord, raw, status) of crops (page, crop_ord, prompt, image); one call a crop, results never recomputed twice
    within a plan if the caller writes or checkpoints them before using them again."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        recogniser = make()
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                try:
                    out.append((r.pdf_path, r.page_index, r.crop_ord, recogniser.read(r.prompt, r.image), "ok"))
                except TimeoutError:
                    out.append((r.pdf_path, r.page_index, r.crop_ord, "", "timeout"))
                except Exception as e:  # a service's failure is a result, not the task's
                    out.append((r.pdf_path, r.page_index, r.crop_ord, "", type(e).__name__))
            yield pd.DataFrame(out, columns=["pdf_path", "page_index", "crop_ord", "raw", "status"])

    return crops.select("pdf_path", "page_index", "crop_ord", "prompt", "image").mapInPandas(run, ANSWERS)


def ocr_words(raw: DataFrame) -> DataFrame:
    """OCR rows (page, word_id, text, conf as text, x, y, w, h) with text and a confidence that is not negative."""
    conf = F.coalesce(F.col("conf").try_cast("double"), F.lit(-1.0))
    return raw.withColumn("conf", conf).filter((strip(F.col("text")) != "") & (F.col("conf") >= 0))


def ocr_text(words: DataFrame) -> DataFrame:
    """(page, ocr_text): a page's words in their order with one space between."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word_id", "text"))), lambda x: x["text"]), " ")
    return words.groupBy("pdf_path", "page_index").agg(joined.alias("ocr_text"))
