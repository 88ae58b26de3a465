"""DataFrame -> DataFrame operators. None runs an action, except ``skew.find_hot``."""
