"""Settings by environment and by flags."""

from __future__ import annotations

import argparse
import os
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace

from .functions.values import CHUNK_CHARS, CHUNK_OVERLAP, SCORE_THRESHOLD

_TRUE = ("1", "true", "yes", "on")


@dataclass(frozen=True)
class Settings:
    """What the stages can be told from outside; `think` None leaves thinking to the model."""

    llm_model: str = "llama3:8b"
    llm_url: str = "http://localhost:11434"
    llm_servers: int = 4
    llm_num_ctx: int = 0
    llm_think: bool | None = None
    llm_force_json: bool = False
    chunk_chars: int = CHUNK_CHARS
    chunk_overlap_chars: int = CHUNK_OVERLAP
    threshold: int = SCORE_THRESHOLD

    @classmethod
    def of_environment(cls, env: Mapping[str, str] | None = None) -> Settings:
        """Each setting by the variable of its name in capitals, where that is set and not blank."""
        env, given = os.environ if env is None else env, {}
        for f in fields(cls):
            raw = env.get(f.name.upper(), "").strip()
            if raw:
                given[f.name] = raw.lower() in _TRUE if "bool" in f.type else int(raw) if f.type == "int" else raw
        return cls(**given)

    def with_flags(self, args: argparse.Namespace) -> Settings:
        """With the flags that were given."""
        known = {f.name for f in fields(self)}
        return replace(self, **{k: v for k, v in vars(args).items() if k in known and v is not None})


# The flags of each stage, with their kinds (a type, or True for a switch)
FLAGS: dict[str, dict[str, object]] = {
    "harvest": {"sources": str, "dry-run": True},
    "score": {"threshold": int, "resume": True, "model": str},
    "peek": {"checkpoint": str, "threshold": int, "out": str, "top": int},
    "bib": {"input": str, "output": str, "allow-duplicates": True},
    "fulltext": {"input": str, "workers": int, "no-resume": True, "resolve-only": True, "text-only": True, "limit": int},
    "extract": {"model": str},
    "analyse": {"input-dir": str, "output-dir": str, "scores-file": str, "max-papers": int},
}


def parser() -> argparse.ArgumentParser:
    """One subcommand a stage, with its flags."""
    top = argparse.ArgumentParser(prog="saltmarsh")
    stages = top.add_subparsers(dest="stage", required=True)
    for stage, flags in FLAGS.items():
        own = stages.add_parser(stage)
        for flag, kind in flags.items():
            dest = {"model": "llm_model"}.get(flag, flag.replace("-", "_"))
            if kind is True:
                own.add_argument(f"--{flag}", action="store_true", dest=dest)
            else:
                own.add_argument(f"--{flag}", type=kind, dest=dest)
    return top
