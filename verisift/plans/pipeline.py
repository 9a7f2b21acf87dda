"""Named stages with a Parquet checkpoint each; a stage that has its output is not run again."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verisift.functions import text as T
from verisift.operators import grading, model_calls, relational
from verisift.sources import readers, writers

Stage = Callable[[DataFrame], DataFrame]


def instructions(folder: str, client: model_calls.Client, templates: dict[str, str], drop_contradictory: bool = False, **options) -> Pipeline:
    """From (key, instruction) to augmented prompts, contradiction labels and checklists, each stage stored in folder.

    templates: augment, contradict and checklist. With drop_contradictory, prompts that contradict themselves get no checklist.
    """

    def augment(df: DataFrame) -> DataFrame:
        return model_calls.augment(df, templates["augment"], client, **options)[0]

    def label(df: DataFrame) -> DataFrame:
        labels = model_calls.label_contradictions(df, templates["contradict"], client, **options)[0]
        return df.join(labels.drop("raw_prompt"), "key")

    def checklist(df: DataFrame) -> DataFrame:
        kept = df.where(~relational.contradictory(F.col("contradiction_label"))) if drop_contradictory else df
        lists = model_calls.extract_checklists(kept, templates["checklist"], client, **options)[0]
        return kept.join(lists.drop("raw_instruction"), "key")

    return Pipeline(folder, [("augmented", augment), ("filtered", label), ("checklist", checklist)])


def rollouts_and_grades(folder: str, actor: model_calls.Client, judge: model_calls.Client, checklists: DataFrame, template: str, dataset: str, n: int = 16, think: bool = True, **options) -> Pipeline:
    """From (key, instruction) to n rollouts of one model and their checklist grades by another, each stage stored in folder."""

    def roll(df: DataFrame) -> DataFrame:
        return model_calls.rollouts(df, actor, n, **options)[0]

    def grade(df: DataFrame) -> DataFrame:
        own = df.withColumn("responses", F.transform("responses", T.strip_thinking)) if think else df
        joined, _ = grading.with_checklist(own, checklists, dataset)
        return model_calls.grade_checklists(joined, template, judge, **options)[0]

    return Pipeline(folder, [("rollouts", roll), ("graded", grade)])


@dataclass
class Pipeline:
    folder: str
    stages: list[tuple[str, Stage]]

    def run(self, df: DataFrame) -> DataFrame:
        for name, stage in self.stages:
            path = f"{self.folder}/{name}"
            # a stored output is read as it is; its stage is not even planned
            df = df.sparkSession.read.parquet(path) if readers.exists(df.sparkSession, f"{path}/_SUCCESS") else writers.write_or_reuse(stage(df), path)
        return df
