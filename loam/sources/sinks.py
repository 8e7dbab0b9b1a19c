"""Manifests, training pairs and the files that a trainer is set up by."""

import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.functions.text import stem
from loam.operators.manifest import union


def _swapped(spark: SparkSession, new: str, path: str) -> None:
    """Puts a finished folder in another's place: what fails before leaves the old one, and readers never meet a half-written one."""
    at = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    fs, old = at(path).getFileSystem(spark._jsc.hadoopConfiguration()), f"{path.rstrip('/')}.old-{uuid.uuid4().hex}"
    had = fs.exists(at(path)) and fs.rename(at(path), at(old))
    if not fs.rename(at(new), at(path)):
        if had:
            fs.rename(at(old), at(path))
        raise OSError(f"can't put {new} in the place of {path}")
    if had:
        fs.delete(at(old), True)


def write_manifest(path: str, *parts: DataFrame, csv: bool = False) -> None:
    """Replaces the manifest, once all of it is written: Parquet with types, or CSV of text for people."""
    out, new = union(*parts, export=csv), f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    out.write.csv(new, header=True, escape='"', emptyValue="") if csv else out.write.parquet(new)
    _swapped(out.sparkSession, new, path)


def _guarded(path: str, inputs: tuple[str, ...]) -> None:
    clean = lambda p: p.replace("\\", "/").rstrip("/")
    if clean(path) in {clean(i) for i in inputs}:
        raise ValueError(f"{path} is an input of this run and would be deleted")


def write_pairs(pairs: DataFrame, path: str, inputs: tuple[str, ...]) -> None:
    """Rows (image_name, caption), replacing what was there; the folder must be none of the inputs."""
    _guarded(path, inputs)
    pairs.write.mode("overwrite").parquet(path)


def _as_files(rows: DataFrame, folder: str, inputs: tuple[str, ...]) -> DataFrame:
    """Writes rows (name, content), a file each, into an emptied folder that all executors reach; one row (name, bytes) a file.

    A task that runs again writes the same files anew.
    """
    from loam.session import materialised

    _guarded(folder, inputs)
    spark = rows.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(at, True)
    fs.mkdirs(at)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        for batch in batches:
            for name, content in zip(batch["name"], batch["content"], strict=True):
                with system.open_output_stream(f"{base}/{name}") as out:
                    out.write(content)
            yield pd.DataFrame({"name": batch["name"], "bytes": batch["content"].map(len)})

    return materialised(rows.select("name", "content").mapInPandas(run, "name string, bytes long"))


def write_pair_files(pairs: DataFrame, folder: str, inputs: tuple[str, ...] = ()) -> DataFrame:
    """Rows (image_name, content, caption) as an image and a UTF-8 text file of the same stem each. Returns (name, bytes) of all."""
    both = F.array(
        F.struct(F.col("image_name").alias("name"), F.col("content").alias("content")),
        F.struct(F.concat(stem(F.col("image_name")), F.lit(".txt")).alias("name"), F.encode(F.coalesce("caption", F.lit("")), "utf-8").alias("content")),
    )
    return _as_files(pairs.select(F.explode(both).alias("f")).select("f.*"), folder, inputs)


def copy_files(items: DataFrame, folder: str, inputs: tuple[str, ...] = ()) -> DataFrame:
    """Files of items (out_name, content) in one flat folder; names must be unique, as ordered.output_names makes them."""
    return _as_files(items.select(F.col("out_name").alias("name"), "content"), folder, inputs)


def check_pairs(images: DataFrame, captions: DataFrame) -> DataFrame:
    """One row (n_images, n_captions); fails as it is read if there is none of one kind."""
    both = images.select(F.lit(True).alias("image")).unionByName(captions.select(F.lit(False).alias("image")))
    n = both.agg(F.count_if("image").alias("n_images"), F.count_if(~F.col("image")).alias("n_captions"))
    fine = (F.col("n_images") > 0) & (F.col("n_captions") > 0)
    return n.where(F.when(fine, True).otherwise(F.raise_error(F.lit("a training set needs images and captions")).cast("boolean")))


def _value(v) -> str:
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, str):
        return f"'{v}'"
    if isinstance(v, (list, tuple)):
        return f"[{', '.join(map(_value, v))}]"
    return str(v)


def toml(tables: dict[str, dict]) -> str:
    """Tables by header ('' for the top), each with its keys in order."""
    blocks = []
    for header, entries in tables.items():
        lines = [header] if header else []
        blocks.append("\n".join(lines + [f"{k} = {_value(v)}" for k, v in entries.items()]))
    return "\n\n".join(blocks) + "\n"


def dataset_toml(folder: str, resolutions: list[int], min_ar: float, max_ar: float, buckets: int, repeats: int) -> str:
    top = {"resolutions": resolutions, "enable_ar_bucket": True, "min_ar": min_ar, "max_ar": max_ar, "num_ar_buckets": buckets, "frame_buckets": [1]}
    return toml({"": top, "[[directory]]": {"path": folder.replace("\\", "/"), "num_repeats": repeats}})


@dataclass(frozen=True)
class Training:
    base_dir: str
    project: str
    model_type: str
    model_file: str
    vae_file: str
    text_encoder: str
    epochs: int
    lr: str
    optimizer: str = "adamw_optimi"
    warmup_steps: int = 100
    save_every_n_epochs: int = 1
    checkpoint_every_n_minutes: int = 999999
    steps_per_print: int = 100
    llm_adapter_lr: float = 0
    tag_dropout_percent: float = 0
    caption_dropout_percent: float = 0.10
    init_from: str = ""


def training_toml(t: Training) -> str:
    """A full finetune: no adapter table. A former run's weights, if named, replace the base model's."""
    base = t.base_dir.replace("\\", "/").rstrip("/")
    run, models, s = f"{base}/outputs/{t.project}", f"{base}/models", asdict(t)
    # What the trainer is always told.
    top = {"output_dir": run, "dataset": f"{run}_dataset_config.toml", "epochs": t.epochs, "micro_batch_size_per_gpu": 1, "pipeline_stages": 1, "gradient_accumulation_steps": 1, "gradient_clipping": 1.0}
    top |= {k: s[k] for k in ("steps_per_print", "warmup_steps")} | {"activation_checkpointing": True, "eval_before_first_step": False, "eval_every_n_epochs": 100000}
    top |= {k: s[k] for k in ("save_every_n_epochs", "checkpoint_every_n_minutes")} | {"save_dtype": "bfloat16"}
    model = {"type": t.model_type, "transformer_path": t.init_from or f"{models}/{t.model_file}", "vae_path": f"{models}/{t.vae_file}", "qwen_path": f"{models}/{t.text_encoder}", "dtype": "bfloat16", "llm_adapter_lr": t.llm_adapter_lr}
    model |= {"cache_text_embeddings": False, "shuffle_tags": False, "tag_delimiter": ", ", "shuffle_keep_first_n": 1, "tag_dropout_percent": t.tag_dropout_percent, "caption_dropout_percent": t.caption_dropout_percent, "caption_mode": "tags", "timestep_sample_method": "logit_normal"}
    optimizer = {"type": t.optimizer, "lr": float(t.lr), "betas": [0.9, 0.99], "weight_decay": 0.01, "eps": 1e-8}
    return toml({"": top, "[model]": model, "[optimizer]": optimizer, "[monitoring]": {"enable_wandb": False}})
