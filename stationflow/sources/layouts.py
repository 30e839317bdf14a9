"""How the kinds of station files are written, and what their header rows hold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple


class Layout(NamedTuple):
    """stamps: the columns whose texts, joined by a blank, are the time stamp; header: row of the names (None: found by where the table starts); first: first row of data; names: to the engine's vocabulary."""

    stamps: Sequence[str]
    formats: Sequence[str]
    header: int | None = 0
    first: int = 1
    names: Mapping[str, str] = {}
    separator: str = ","


class Signature(NamedTuple):
    """Header names of a kind: the listed ones, and those of the pattern that aren't excepted."""

    names: Sequence[str]
    pattern: str | None = None
    excepted: Sequence[str] = ()


#: How the layouts are written, and their names in the engine's vocabulary.
LAYOUTS = {
    "eddypro": Layout(("date", "time"), ("yyyy-M-d H:mm", "d.M.yyyy H:mm", "d/M/yyyy H:mm", "yyyy-M-d H:mm:ss"), 1, 3, {"u*": "u_star", "co2_signal_strength_7500_mean": "co2_signal_strength"}),
    "biomet": Layout(("TIMESTAMP_1",), ("yyyy-M-d HHmm", "d.M.yyyy H:mm"), 0, 2, {"Ta_1_1_1": "ta", "RH_1_1_1": "rh", "Rg_1_1_1": "rg", "Swin_1_1_1": "swin", "Swout_1_1_1": "swout", "P_1_1_1": "p_rain"}),
    "csf": Layout(("TIMESTAMP",), ("yyyy-M-d H:mm:ss", "d.M.yyyy H:mm"), 1, 4, {"FC": "co2_flux", "FC_QC": "qc_co2_flux", "LE_QC": "qc_le", "H_QC": "qc_h", "USTAR": "u_star", "T_SONIC": "sonic_temperature", "CO2_sig_strgth_Min": "co2_signal_strength"}),
    "ias": Layout(("TIMESTAMP_START",), ("yyyyMMddHHmm",), 0, 1, {"FC_1_1_1": "co2_flux", "FC_SSITC_TEST_1_1_1": "qc_co2_flux", "LE_1_1_1": "le", "H_1_1_1": "h", "USTAR_1_1_1": "u_star", "TA_1_1_1": "ta", "RH_1_1_1": "rh", "SW_IN_1_1_1": "swin", "P_RAIN_1_1_1": "p_rain", "VPD_PI_1_1_1": "vpd", "CO2_STR_1_1_1": "co2_signal_strength", "CH4_RSSI_1_1_1": "ch4_signal_strength", "FCH4_1_1_1": "ch4_flux"}),
    "fluxnet15": Layout(("TIMESTAMP_END",), ("yyyyMMddHHmm",), 0, 1, {"NEE_VUT_REF": "nee", "LE_F_MDS": "le", "H_F_MDS": "h", "SW_IN_F_MDS": "swin", "TA_F_MDS": "ta", "TS_F_MDS_1": "ts", "RH": "rh", "VPD_F_MDS": "vpd", "USTAR": "u_star"}),
}
#: Layouts whose vapour pressure deficits are in hPa.
IN_HPA = ("ias", "fluxnet15")
#: Columns of the layouts that are no variables.
NO_VARIABLES = ("timestamp_start", "timestamp_end", "dtime", "filename", "doy", "record")
#: Layouts by their names as file types (tables.detect_import_mode).
TYPES = {"eddypro": "EDDYPRO_FO", "biomet": "EDDYPRO_BIOMET", "csf": "CSF", "ias": "IAS"}

#: Header names of the layouts.
WEATHER = ("TIMESTAMP_1", "Ta_1_1_1", "RH_1_1_1", "Rg_1_1_1", "Lwin_1_1_1", "Lwout_1_1_1", "Swin_1_1_1", "Swout_1_1_1", "P_1_1_1")
FULL_OUTPUT = """filename date time DOY daytime file_records used_records Tau qc_Tau H qc_H LE qc_LE co2_flux qc_co2_flux h2o_flux qc_h2o_flux H_strg LE_strg co2_strg h2o_strg co2_v-adv h2o_v-adv
co2_molar_density co2_mole_fraction co2_mixing_ratio co2_time_lag co2_def_timelag h2o_molar_density h2o_mole_fraction h2o_mixing_ratio h2o_time_lag h2o_def_timelag sonic_temperature air_temperature
air_pressure air_density air_heat_capacity air_molar_volume ET water_vapor_density e es specific_humidity RH VPD Tdew u_unrot v_unrot w_unrot u_rot v_rot w_rot wind_speed max_wind_speed wind_dir yaw
pitch roll u* TKE L (z-d)/L bowen_ratio T* model x_peak x_offset x_10% x_30% x_50% x_70% x_90% un_Tau Tau_scf un_H H_scf un_LE LE_scf un_co2_flux co2_scf un_h2o_flux h2o_scf spikes_hf
amplitude_resolution_hf drop_out_hf absolute_limits_hf skewness_kurtosis_hf skewness_kurtosis_sf discontinuities_hf discontinuities_sf timelag_hf timelag_sf attack_angle_hf non_steady_wind_hf
u_spikes v_spikes w_spikes ts_spikes co2_spikes h2o_spikes chopper_LI-7500 detector_LI-7500 pll_LI-7500 sync_LI-7500 mean_value_RSSI_LI-7500 u_var v_var w_var ts_var co2_var h2o_var w/ts_cov
w/co2_cov w/h2o_cov vin_sf_mean co2_mean h2o_mean dew_point_mean co2_signal_strength_7500_mean""".split()
FLUX_LOGGER = """TIMESTAMP RECORD FC FC_QC FC_mass FC_samples LE LE_QC LE_samples H H_QC H_samples TAU TAU_QC USTAR T_SONIC T_SONIC_SIGMA WS_RSLT CO2 CO2_sig_strgth_Min FETCH_MAX FETCH_90 FETCH_80 FETCH_70
FETCH_FILTER FETCH_INTRST FP_FETCH_INTRST FTPRNT_EQUATION MO_LENGTH_1_1_1 ZL_1_1_1 co2_signal_strength ch4_signal_strength ET ET_QC ET_samples Bowen_ratio TSTAR TKE e e_sat PA PA_SIGMA VPD U U_SIGMA
V V_SIGMA W W_SIGMA sonic_azimuth WS WD_SONIC WD_SIGMA WD WS_MAX CO2_SIGMA CO2_mixratio CO2_mixratio_SIGMA CO2_density CO2_density_SIGMA H2O H2O_SIGMA H2O_mixratio H2O_mixratio_SIGMA H2O_density
H2O_density_SIGMA H2O_sig_strgth_Min sun_azimuth sun_elevation hour_angle sun_declination air_mass_coeff daytime""".split()
#: Exchange names are capitals with three indices, so a pattern stands for their list.
SIGNATURES = {
    "ias": Signature(("TIMESTAMP_START", "TIMESTAMP_END", "DTime"), "^[A-Z][A-Z0-9_]*(_[0-9]+){3}$", WEATHER),
    "biomet": Signature(WEATHER),
    "eddypro": Signature(FULL_OUTPUT),
    "csf": Signature(FLUX_LOGGER),
}
