"""Settings changed in a test reach the workers too: a module goes there by value."""

from contextlib import contextmanager

from pyspark import cloudpickle


@contextmanager
def by_value(module):
    cloudpickle.register_pickle_by_value(module)
    try:
        yield
    finally:
        cloudpickle.unregister_pickle_by_value(module)
