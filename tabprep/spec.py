"""Job spec: dataset, ML and generation sections as one dataclass."""

from __future__ import annotations

from dataclasses import dataclass

TASKS = ("classification", "regression")
# The learner objectives that job specs name, by task.
OBJECTIVES = {"binary:logistic": "classification", "reg:linear": "regression",
              "reg:squarederror": "regression"}
STRATEGIES = (None, "balance", "augment", "replace")


@dataclass
class TabularSpec:
    target_column: str
    ml_task: str = "classification"
    drop_columns: list[str] | str | None = None
    train_path: str | None = None
    validation_path: str | None = None
    test_path: str | None = None
    objective: str | None = None
    objective_type: str = "Maximize"
    ml_eval_metric: str = "f1"
    ml_metric_threshold: float = 0.0
    strategy: str | None = None
    generate_factor: float = 1.0
    target_balance: float | None = 1.0
    key_column: str | None = None
    seed: int = 42

    def __post_init__(self):
        if self.ml_task not in TASKS:
            raise ValueError(f"ml_task must be one of {TASKS}, got {self.ml_task!r}")
        if self.objective is None:
            self.objective = "binary:logistic" if self.ml_task == "classification" else "reg:squarederror"
        if OBJECTIVES.get(self.objective) != self.ml_task:
            raise ValueError(f"objective {self.objective!r} does not fit the task {self.ml_task!r}; "
                             f"known objectives: {sorted(OBJECTIVES)}")
        if self.strategy not in STRATEGIES:
            raise ValueError(f"unknown generation strategy {self.strategy!r}; "
                             f"expected one of {STRATEGIES}")
        # A string is one column name, never a substring pattern.
        if self.drop_columns is None:
            self.drop_columns = []
        elif isinstance(self.drop_columns, str):
            self.drop_columns = [self.drop_columns]
        else:
            self.drop_columns = list(self.drop_columns)
        # A missing balance means full balance (1.0).
        if self.target_balance is None:
            self.target_balance = 1.0
        direction = self.objective_type.strip().lower()
        if direction not in ("maximize", "minimize"):
            raise ValueError(f"objective_type must be Maximize or Minimize, got {self.objective_type!r}")
        self.objective_type = direction

    @property
    def maximize(self) -> bool:
        return self.objective_type == "maximize"

    @classmethod
    def from_dict(cls, d: dict) -> "TabularSpec":
        """Build from the three-section layout: dataset, ML and a generation
        section (strategy, generate_factor, target_balance); hosted-service
        keys such as ``mode`` or ``sink_bucket`` are ignored."""
        ds = d.get("dataset", {})
        ml = d.get("ML", {})
        # the generation section is whichever other section holds "strategy"
        gen = next((v for k, v in d.items() if k not in ("dataset", "ML")
                    and isinstance(v, dict) and "strategy" in v), {}) or {}
        return cls(
            target_column=ds["target_column"],
            drop_columns=ds.get("drop_columns"),
            train_path=ds.get("train_path"),
            validation_path=ds.get("validation_path"),
            test_path=ds.get("test_path"),
            ml_task=ml.get("ml_task", "classification"),
            objective=ml.get("objective"),
            objective_type=ml.get("objective_type", "Maximize"),
            ml_eval_metric=ml.get("ml_eval_metric", "f1"),
            ml_metric_threshold=float(ml.get("ml_metric_threshold", 0.0)),
            strategy=gen.get("strategy"),
            # only a missing value takes the default; 0 generates nothing
            generate_factor=1.0 if gen.get("generate_factor") is None else float(gen["generate_factor"]),
            target_balance=gen.get("target_balance"),
        )
