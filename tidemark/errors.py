"""Errors raised by the loader."""


from pyspark.errors import PySparkException


class OptionError(ValueError):
    """An option is missing, malformed, or contradicts another one."""


class LoadError(RuntimeError):
    """The source could not be read; ``__cause__`` holds the reason."""


try:  # a session of Spark Connect has no JVM of its own
    from py4j.protocol import Py4JJavaError

    SPARK_ERRORS = (PySparkException, Py4JJavaError)
except ImportError:
    SPARK_ERRORS = (PySparkException,)
