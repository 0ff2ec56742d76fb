"""Training, evaluation and scoring with Spark ML tree ensembles."""

from .matrix import matrix_stages
from .predict import generate_forecast, score
from .train import (SalesModel, TrainingResult, feature_importance, initialize_model, load_model, save_model,
                    train_model)

__all__ = [
    "SalesModel", "TrainingResult", "feature_importance", "generate_forecast", "initialize_model", "load_model",
    "matrix_stages", "save_model", "score", "train_model",
]
