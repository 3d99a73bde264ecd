"""Photometric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyloom import constants as K


def snr(flux: Column, err: Column) -> Column:
    """Signal to noise; null for zero error."""
    return F.try_divide(flux, err)


def abmag(flux: Column) -> Column:
    """AB magnitude of a nanomaggy flux; 0 when the flux is not positive."""
    return F.when(flux <= 0, F.lit(0.0)).otherwise(F.log10(flux) * -2.5 + K.NANOMAGGY_ZP)


def mag_unguarded(flux: Column) -> Column:
    """The same formula without the guard; null when the flux is not positive."""
    return F.log10(flux) * -2.5 + K.NANOMAGGY_ZP


def calibrated_mag(flux: Column, zp: Column, apcor: Column) -> Column:
    """Instrumental flux to magnitude with zeropoint and aperture correction."""
    return F.log10(flux) * -2.5 + zp + apcor


def magerr(flux: Column, err: Column) -> Column:
    """Magnitude error."""
    return F.try_divide(err * K.MAGERR_FACTOR, flux)


def lim_mag(err: Column, zp: Column) -> Column:
    """5 sigma limiting magnitude."""
    return F.log10(err * 5.0) * -2.5 + zp


def fluxscale(zp: Column, ref: float = K.STACK_ZP) -> Column:
    """Factor that brings a flux to zeropoint ``ref``."""
    return F.pow(F.lit(10.0), (zp - ref) * -0.4)


def shape_ratios(a: Column, b: Column, fwhm: Column) -> Column:
    """Both axes over the FWHM."""
    return F.struct(F.try_divide(a, fwhm).alias("aimagerat"), F.try_divide(b, fwhm).alias("bimagerat"))
