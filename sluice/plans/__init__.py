from .pipelines import audit, clean_table, merge_folder, missing_parts, balance_train_score

__all__ = ["audit", "clean_table", "merge_folder", "missing_parts", "balance_train_score"]
