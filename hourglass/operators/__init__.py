"""DataFrame -> DataFrame operators.

``clean`` (C7-C13), ``profile`` (P1-P13), ``filters`` (F1-F7, J0-J3), ``joins`` (K1-K4),
``aggregate`` (A1-A7), ``order`` (T1-T5, U1-U2), ``sample`` (B1-B4), ``scale`` (X17-X20),
``model`` (M1-M14). None of them starts a Spark job except the broadcast size check
in ``joins`` and the fit/eval functions in ``model``.
"""
