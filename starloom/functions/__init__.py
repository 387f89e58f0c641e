from .exact import exact_sum, half_up_div, money, percent_label, scaled_decimal, whole_units

__all__ = ["exact_sum", "half_up_div", "money", "percent_label", "scaled_decimal", "whole_units"]
