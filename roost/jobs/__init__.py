"""Entry points for spark-submit; `python -m roost.jobs.<name> --help` lists options."""
