"""Pipeline configuration: typed, read from JSON, with the step and tool names of the config file as keys."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field

#: Versions, steps and the tool of the configuration file.
VERSIONS = {"v0": "generated questions", "v1": "after the evidence check", "v2": "after labelling", "v3": "after refinement", "v4": "after shuffle and blind rounds", "final": "copy of v4"}
STEPS = ("step_0_generate_qa", "step_1_full_context", "step_2_label", "step_3_new_qa", "step_4_pollution_check")
TOOLS = ("option_perturbation",)


@dataclass(frozen=True)
class ModelConfig:
    model: str = ""
    base_url: str = ""
    api_key: str = ""

    def to_dict(self) -> dict[str, str]:
        return {"model": self.model, "base_url": self.base_url, "api_key": self.api_key}


@dataclass(frozen=True)
class PipelineConfig:
    input_dir: str = "dataset"
    output_dir: str = "result"
    temp_dir: str = "temp"
    max_workers: int = 4
    version_prefix: str = "v"

    def version_path(self, version: str, dataset: str) -> str:
        return os.path.join(self.output_dir if version == "final" else self.temp_dir, f"{dataset}_{version}")


@dataclass(frozen=True)
class Config:
    pipeline: PipelineConfig = PipelineConfig()
    steps: dict = field(default_factory=dict)
    tools: dict = field(default_factory=dict)

    @classmethod
    def load(cls, path: str) -> Config:
        """Read a file; a missing one is an error, and no other file is read first."""
        with open(path, encoding="utf-8") as f:
            raw = json.load(f)
        known = {k: v for k, v in raw.get("pipeline", {}).items() if k in PipelineConfig.__dataclass_fields__}
        return cls(PipelineConfig(**known), raw.get("steps", {}), raw.get("tools", {}))

    def step(self, name: str) -> dict:
        if name not in self.steps:
            raise KeyError(f"unknown step {name}; known: {', '.join(self.steps)}")
        return self.steps[name]

    def step_model(self, name: str) -> ModelConfig:
        own = self.step(name).get("llm", {})
        return ModelConfig(own.get("model", ""), own.get("base_url", ""), own.get("api_key", ""))

    def step_flag(self, name: str, flag: str, default: bool = False) -> bool:
        return bool(self.step(name).get(flag, default))

    def tool(self, name: str) -> dict:
        if name not in self.tools:
            raise KeyError(f"unknown tool {name}; known: {', '.join(self.tools)}")
        return self.tools[name]

    def perturbation_models(self) -> tuple[str, str]:
        own = self.tool("option_perturbation").get("llm", {})
        return own.get("gen_model", ""), own.get("score_model", "")

    def summary(self) -> str:
        """All settings as text; keys are hidden."""
        lines = [f"{k}: {getattr(self.pipeline, k)}" for k in PipelineConfig.__dataclass_fields__]
        for name, step in [*self.steps.items(), *self.tools.items()]:
            model = step.get("llm", {})
            lines.append(f"{name}: {step.get('description', '')} [{model.get('model') or model.get('gen_model', '-')}]")
        return "\n".join(lines)
