"""Models behind document info and notes: chat clients by provider, answers by schema, fallbacks.

A model is a function from (kind, context) to a mapping. Clients are optional libraries, loaded in
the worker that first asks; any function from a prompt to a text can stand in for one.
"""

from __future__ import annotations

import importlib
import json
import re
from collections.abc import Callable

from ..schemas import INFO
from .extract import with_fallback

Chat = Callable[[str], str]

#: Provider: module and class of its client, and fixed options; names that mean the same follow.
PROVIDERS = {
    "gemini": ("langchain_google_genai", "ChatGoogleGenerativeAI", {}),
    "openai": ("langchain_openai", "ChatOpenAI", {}),
    "openrouter": ("langchain_openai", "ChatOpenAI", {"base_url": "https://openrouter.ai/api/v1"}),
    "groq": ("langchain_groq", "ChatGroq", {}),
    "ollama": ("langchain_ollama", "ChatOllama", {}),
}
SAME = {"google": "gemini", "google_genai": "gemini", "openai-compatible": "openai"}

#: What is asked for by kind: an instruction, and the fields of the answer.
ASKED = {
    "document_info": ("Fill in what the text says of the document as a whole. Copy names, dates and numbers as they are printed.", {f: "text or null" for f in INFO}),
    "field_notes": ("List every dated or labelled observation of the text, in order, each copied word for word.", {"notes": [{"date_raw": "text or null", "area": "text or null", "text": "text"}]}),
}


def chat(provider: str, model: str, **options) -> Chat:
    """A provider's chat model at temperature 0; ``options`` (api_key, base_url) go to its client."""
    name = SAME.get(provider.lower(), provider.lower())
    if name not in PROVIDERS:
        raise ValueError(f"unknown provider {provider!r}; there are {', '.join(PROVIDERS)}")
    module, client, fixed = PROVIDERS[name]
    made = []

    def ask(prompt: str) -> str:
        if not made:
            try:
                kind = getattr(importlib.import_module(module), client)
            except ImportError as error:
                raise ValueError(f"the provider {name} needs {module} on the executors") from error
            made.append(kind(model=model, temperature=0, **(fixed | {k: v for k, v in options.items() if v is not None})))
        return str(made[0].invoke(prompt).content)

    return ask


def prompt(kind: str, context: str) -> str:
    instruction, shape = ASKED[kind]
    return f"{instruction}\nUse only the text between the marks. What it doesn't say is null.\nAnswer with one JSON object of this shape and nothing else:\n{json.dumps(shape)}\n<text>\n{context}\n</text>"


def parsed(kind: str, said: str) -> dict:
    """The JSON object of an answer, with the asked fields only; anything else raises."""
    found = re.search(r"\{.*\}", said, re.S)
    if found is None:
        raise ValueError("the answer is no JSON object")
    answer = json.loads(found[0])
    return {k: answer.get(k) for k in ASKED[kind][1]}


def structured(ask: Chat) -> Callable[[str, str], dict]:
    """A chat model as a model of document info and notes."""
    return lambda kind, context: parsed(kind, ask(prompt(kind, context)))


def model(provider: str, name: str, fallback: tuple[str, str] | None = None, **options) -> Callable[[str, str], dict]:
    """A provider's model, and another's (provider, name) where the first has no quota left."""
    second = (lambda: structured(chat(*fallback))) if fallback else None
    return with_fallback(structured(chat(provider, name, **options)), second)
