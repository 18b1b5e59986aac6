"""Rule-based stand-ins for the model functions: deterministic, no network.

They answer from the words of the prompt alone, as a remote model would, so enrichment can be
run and checked end to end without one.
"""

import json
import re

_ITEM = re.compile(r"^(\d+)\. Nom: \"(.*?)\"", re.MULTILINE)


def _reply(prompt: str, answer) -> str:
    found = {number: answer(name.lower()) for number, name in _ITEM.findall(prompt)}
    kept = {number: value for number, value in found.items() if value is not None}
    return "```json\n" + json.dumps(kept, ensure_ascii=False) + "\n```"


def steps(prompt: str) -> str:
    """Step by noun; a "rod" gets an unknown step, an "anvil" no answer."""
    words = {"ring": "DESSERTS", "plate": "plats", "bolt": " Boissons ", "gear": "Sauces", "rod": "?"}
    return _reply(prompt, lambda name: next((s for w, s in words.items() if w in name), None))


def roles(prompt: str) -> str:
    return _reply(prompt, lambda name: "SIDE" if "small" in name or "cold" in name else "main")


def drinks(prompt: str) -> str:
    """Drink by adjective; nothing for the others."""
    words = {"red": "vin", "hot": "CHAUD", "cold": "eau", "blue": "unknown"}
    return _reply(prompt, lambda name: next((s for w, s in words.items() if w in name), None))


def events(prompt: str) -> str:
    def answer(name: str):
        if "ring" in name:
            return ["mariage", "ANNIVERSAIRE", "mariage"]
        if "plate" in name:
            return ["Barbecue", "all"]
        return "Barbecue" if "gear" in name else ["nothing known"]

    return _reply(prompt, answer)


def diets(prompt: str) -> str:
    def answer(name: str):
        if "hot" in name:
            return {"profil": "Viande", "contient": ["porc", "viande", "porc"]}
        if "cold" in name:
            return {"profil": "vegan", "contient": ["poisson"]}
        return {"profil": "vegetarien", "contient": ["oeuf", "lait", "?"]}

    return _reply(prompt, answer)


def embedder(texts: list[str]) -> list[list[float]]:
    """Length, words and letters "e" of each text."""
    return [[float(len(t)), float(len(t.split(" "))), float(t.count("e"))] for t in texts]


class Flaky:
    """A model function that fails the first time it gets a prompt."""

    def __init__(self, call):
        self.call, self.seen = call, set()

    def __call__(self, prompt: str) -> str:
        if prompt not in self.seen:
            self.seen.add(prompt)
            raise ConnectionError("try again")
        return self.call(prompt)
