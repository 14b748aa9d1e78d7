from dqspark.functions import constants, text  # noqa: F401
